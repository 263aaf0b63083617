"""Trained forecasters on the dense hourly readings. Fits have no SQL twin: property tests check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.clean import CALENDAR_SQL
from queries.common import (
    EV, SENSORS, TRAIN_END, VALIDATION_END, query, r6, readings_dense, rounded, s6, with_views,
)
from sensorspark import constants as K
from sensorspark.operators import evaluate, models, split
from sensorspark.plans import flows, reports, run_store
from sensorspark.plans.shared import materialize


def config(*families: str) -> models.ForecastConfig:
    """Whole table, published flow, presets, lags and windows."""
    return models.ForecastConfig(
        granularity="hourly", min_date=None, train_end=TRAIN_END, validation_end=VALIDATION_END, families=families)


def _train(spark, folder, *families):
    """Run of the store: trained by the first query that asks for it, models of a family shared by all runs."""
    return run_store.trained(readings_dense(spark, folder), config(*families))


_DENSE = """readings_h AS (
  SELECT region, date_trunc('hour', date_time) AS date_time, avg(value) AS pm2_5, avg(value * 2.5 + ws) AS pm10,
         avg(ws * 4) AS so2, max(ws) AS temp, min(wd) / 3.6::DOUBLE AS hum, avg(ws) AS ws, avg(wd) AS wd
  FROM ev GROUP BY 1, 2),
spine AS (
  SELECT region, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS date_time
  FROM (SELECT region, min(date_time) AS a, max(date_time) AS b FROM readings_h GROUP BY 1)),
grid AS (
  SELECT spine.region, spine.date_time, CASE WHEN r.region IS NULL THEN 0 ELSE 1 END AS observed_row, r.* EXCLUDE (region, date_time)
  FROM spine LEFT JOIN readings_h r ON spine.region = r.region AND spine.date_time = r.date_time),
leads AS (
  SELECT *, lead(observed_row) OVER w AS observed_future, """ + ", ".join(
    f"lead({t}) OVER w AS target_{t}" for t in K.TARGETS) + """
  FROM grid WINDOW w AS (PARTITION BY region ORDER BY date_time))"""


def _frame_sql():
    """Select list of the model frame, with all published lags and windows."""
    def rolled(c, w, f):
        over = f"OVER (PARTITION BY region ORDER BY date_time ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        return s6(f"CASE WHEN count({c}) {over} >= {max(2, w // 2)} THEN {f}({c}) {over} END")

    lags = [s6(f"lag({c}, {k}) OVER (PARTITION BY region ORDER BY date_time)", f"{c}_lag_{k}") for c in SENSORS for k in K.LAGS["hourly"]]
    rolls = [f"{rolled(c, w, f)} AS {c}_roll_{n}_{w}" for c in K.ROLLING_SENSORS for w in K.WINDOWS["hourly"]
             for n, f in (("mean", "avg"), ("std", "stddev_samp"))]
    hot = [f"CAST(region = '{r}' AS INT) AS region_{r}" for r in K.REGIONS]
    usable = " AND ".join(["observed_row = 1", "observed_future = 1", *[f"target_{t} IS NOT NULL" for t in K.TARGETS]])
    label = (f"CASE WHEN {usable} THEN CASE WHEN date_time <= TIMESTAMP '{TRAIN_END}' THEN 'train' "
             f"WHEN date_time <= TIMESTAMP '{VALIDATION_END}' THEN 'validation' ELSE 'test' END END AS split")
    wind = [s6("sin(radians(wd))", "wd_sin"), s6("cos(radians(wd))", "wd_cos")]
    return ", ".join(["region", "date_time", "'hourly' AS granularity", *[s6(c, c) for c in SENSORS], "observed_row",
                      *lags, *rolls, "observed_future", *[s6(f"target_{t}", f"target_{t}") for t in K.TARGETS],
                      CALENDAR_SQL, *wind, *hot, label])


@query("model_frame", with_views(EV, _DENSE, tail=f"SELECT {_frame_sql()} FROM leads"))
def model_frame(spark, folder):
    base = split.base_load(readings_dense(spark, folder), "hourly", None)
    frame = models.model_frame(base, config("random_forest"))
    doubles = [c for c, t in frame.dtypes if t == "double"]
    return rounded(frame, *doubles)


def _test_metrics(run):
    rows = evaluate.overall(run.metrics).where("split = 'test'")
    return rounded(rows, "rmse", "mae", "r2")


@query("rf_forecast")
def rf_forecast(spark, folder):
    return _test_metrics(_train(spark, folder, "random_forest"))


@query("gbt_forecast")
def gbt_forecast(spark, folder):
    return _test_metrics(_train(spark, folder, "lightgbm", "xgboost"))


@query("best_strategy_scoring")
def best_strategy_scoring(spark, folder):
    """Every reading scored by the winner of its station and target."""
    run = _train(spark, folder, "random_forest", "lightgbm")
    requests = models.spread(readings_dense(spark, folder).drop("granularity"), run.bundle.metadata["dataset"]["rows"])
    scored = flows.score(run.bundle, requests, "best")
    return scored.select("region", "date_time", *[c for t in run.bundle.targets for c in (f"{t}_forecast", f"{t}_strategy")],
                         F.col("risk.category").alias("category"), "summary",
                         F.size("anomaly_alerts").alias("alerts"), "feature_count")


@query("feature_importance")
def feature_importance(spark, folder):
    run = _train(spark, folder, "random_forest")
    top = models.bundle_importance(spark, run.bundle)
    return top.select("position", "feature", r6("importance").alias("importance"))


@query("run_metadata")
def run_metadata(spark, folder):
    run = _train(spark, folder, "random_forest")
    meta, contract = reports.serving_metadata(spark, run.bundle), reports.inference_contract(spark, run.bundle)
    return meta.select(F.lit("metadata").alias("document"), F.to_json(F.struct("*")).alias("json")).unionByName(
        contract.select(F.lit("contract").alias("document"), F.to_json(F.struct("*")).alias("json")))


@query("run_report_long")
def run_report_long(spark, folder):
    run = _train(spark, folder, "random_forest")
    best = materialize(run.bundle.best, "best")
    return reports.long_report(models.config_row(spark, config("random_forest")), run.coverage, run.split_counts,
                               run.metrics, best)
