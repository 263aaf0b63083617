"""Metrics, leaderboards, winners and strategy lookups on model-free predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import (
    EV, RH, TRAIN_END, VALIDATION_END, event_readings, query, readings_h, rounded, s6, table, with_views,
)
from sensorspark import constants as K
from sensorspark.functions.times import ntz
from sensorspark.operators import evaluate, models, selector
from sensorspark.operators.series import guarded, over_series, previous_rows
from sensorspark.plans import reports

_STRATEGIES = ("naive_last", "naive_mean24")


def wide_preds(spark, folder):
    """Two model-free strategies and the next reading, for every target."""
    def build(w):
        day, out = previous_rows(w, 24), {}
        for t in K.TARGETS:
            out[f"actual_{t}"] = F.lead(t, 1).over(w)
            out[f"naive_mean24_pred_{t}"] = guarded(F.avg(t), F.col(t), day, 1)
        return out

    rows = over_series(readings_h(spark, folder).select("region", "date_time", *K.TARGETS), build, back=24, ahead=1)
    split = F.when(F.col("date_time") <= ntz(TRAIN_END), F.lit("train")).when(
        F.col("date_time") <= ntz(VALIDATION_END), F.lit("validation")).otherwise(F.lit("test"))
    return rows.withColumns({"split": split, **{f"naive_last_pred_{t}": F.col(t) for t in K.TARGETS}})


def preds(spark, folder):
    return evaluate.long_predictions(
        wide_preds(spark, folder), {s: {t: f"{s}_pred_{t}" for t in K.TARGETS} for s in _STRATEGIES},
        {t: f"actual_{t}" for t in K.TARGETS})


PREDS = "wide AS (SELECT region, date_time, CASE WHEN date_time <= TIMESTAMP '" + TRAIN_END + \
    "' THEN 'train' WHEN date_time <= TIMESTAMP '" + VALIDATION_END + "' THEN 'validation' ELSE 'test' END AS split, " + ", ".join(
        f"lead({t}) OVER w AS actual_{t}, {t} AS naive_last_pred_{t}, avg({t}) OVER (PARTITION BY region ORDER BY date_time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS naive_mean24_pred_{t}"
        for t in K.TARGETS) + " FROM readings_h WINDOW w AS (PARTITION BY region ORDER BY date_time)),\npreds AS (" + " UNION ALL ".join(
        f"SELECT region, date_time, split, '{s}' AS strategy, '{t}' AS target, actual_{t} AS actual, {s}_pred_{t} AS predicted FROM wide"
        for s in _STRATEGIES for t in K.TARGETS) + ")"
METRICS = """metrics AS (
  SELECT strategy, split, target, region, sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs(actual - predicted)) AS mae,
         1 - sum((actual - predicted) ** 2) / nullif(var_pop(actual) * count(actual), 0) AS r2, count(*) AS rows,
         CAST(grouping(region) AS INT) AS is_overall
  FROM preds WHERE actual IS NOT NULL AND predicted IS NOT NULL
  GROUP BY GROUPING SETS ((strategy, split, target, region), (strategy, split, target)))"""
_VALUES = ("rmse", "mae", "r2")
_VALUES_SQL = ", ".join(s6(v, v) for v in _VALUES)


def metrics(spark, folder):
    return evaluate.metrics_by_region(preds(spark, folder))


@query("predictions_wide", with_views(EV, RH, PREDS, tail="SELECT region, date_time, " + ", ".join(
    s6(c, c) for c in [f"actual_{t}" for t in K.TARGETS] + [f"{s}_pred_{t}" for s in _STRATEGIES for t in K.TARGETS]) + " FROM wide"))
def predictions_wide(spark, folder):
    out = evaluate.wide_predictions(preds(spark, folder), _STRATEGIES)
    return rounded(out, *[c for c in out.columns if c not in ("region", "date_time")])


@query("regression_metrics", with_views(EV, RH, PREDS, tail="""SELECT target, strategy,
  round(sqrt(avg((actual - predicted) ** 2)) + 1e-9, 6) AS rmse, round(avg(abs(actual - predicted)) + 1e-9, 6) AS mae,
  round(1 - sum((actual - predicted) ** 2) / nullif(var_pop(actual) * count(actual), 0) + 1e-9, 6) AS r2, count(*) AS rows
FROM preds WHERE actual IS NOT NULL AND predicted IS NOT NULL GROUP BY 1, 2"""))
def regression_metrics(spark, folder):
    return rounded(evaluate.regression_metrics(preds(spark, folder), ["target", "strategy"]), *_VALUES)


@query("metrics_grouping_sets", with_views(EV, RH, PREDS, METRICS, tail=f"SELECT strategy, split, target, region, {_VALUES_SQL}, rows, is_overall FROM metrics"))
def metrics_grouping_sets(spark, folder):
    return rounded(metrics(spark, folder).withColumn("is_overall", F.col("is_overall").cast("int")), *_VALUES)


@query("leaderboard", with_views(EV, RH, PREDS, METRICS, tail="""
SELECT strategy, round(avg(rmse) + 1e-9, 6) AS mean_rmse, round(avg(mae) + 1e-9, 6) AS mean_mae, round(avg(r2) + 1e-9, 6) AS mean_r2,
  count(DISTINCT target) AS targets FROM metrics WHERE is_overall = 1 AND split = 'test' GROUP BY 1"""))
def leaderboard(spark, folder):
    board = evaluate.leaderboard(evaluate.overall(metrics(spark, folder)), "test")
    return rounded(board, "mean_rmse", "mean_mae", "mean_r2")


_BEST = """best AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY region, target ORDER BY rmse, mae, strategy) AS n
  FROM metrics WHERE is_overall = 0 AND split = 'validation') WHERE n = 1)"""


@query("best_strategy_table", with_views(EV, RH, PREDS, METRICS, _BEST, tail=f"SELECT region, target, strategy, split, {_VALUES_SQL}, rows FROM best"))
def best_strategy_table(spark, folder):
    return rounded(evaluate.best_strategies(metrics(spark, folder)), *_VALUES)


@query("target_leaderboard", with_views(EV, RH, PREDS, METRICS, tail=f"""
SELECT strategy, target, {_VALUES_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY rmse, mae, strategy) AS n FROM metrics WHERE is_overall = 1 AND split = 'test')
WHERE n = 1"""))
def target_leaderboard(spark, folder):
    test = evaluate.overall(metrics(spark, folder)).where("split = 'test'")
    return rounded(evaluate.target_leaderboard(test), *_VALUES)


@query("metric_pivot", with_views(EV, RH, PREDS, METRICS, _BEST, tail="SELECT region, " + ", ".join(
    s6(f"max(rmse) FILTER (WHERE target = '{t}')", t) for t in K.TARGETS) + " FROM best GROUP BY 1"))
def metric_pivot(spark, folder):
    return rounded(evaluate.metric_pivot(evaluate.best_strategies(metrics(spark, folder))), *K.TARGETS)


@query("strategy_choice", with_views(EV, RH, PREDS, METRICS, """valid AS (SELECT * FROM metrics WHERE is_overall = 1 AND split = 'validation')""", tail="""
SELECT 'multi_output' AS scope, 'all' AS target, (SELECT strategy FROM valid GROUP BY 1 ORDER BY avg(rmse), avg(mae), strategy LIMIT 1) AS strategy
UNION ALL SELECT 'single_target', target, strategy FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY rmse, mae, strategy) AS n FROM valid) WHERE n = 1"""))
def strategy_choice(spark, folder):
    valid = evaluate.overall(metrics(spark, folder)).where("split = 'validation'")
    top = evaluate.leaderboard(valid).limit(1).select(
        F.lit("multi_output").alias("scope"), F.lit("all").alias("target"), "strategy")
    single = evaluate.best_rows(valid, ["target"]).select(F.lit("single_target").alias("scope"), "target", "strategy")
    return top.unionByName(single)


@query("performance_ranking", with_views(EV, RH, PREDS, METRICS, _BEST, tail=f"SELECT region || ' ' || target AS label, {s6('r2', 'r2')} FROM best"))
def performance_ranking(spark, folder):
    ranked = evaluate.performance_ranking(evaluate.best_strategies(metrics(spark, folder)))
    return rounded(ranked.select("label", "r2"), "r2")


@query("last_n_per_region", with_views(EV, RH, tail=f"""
SELECT region, date_time, {s6('pm2_5', 'pm2_5')} FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY date_time DESC) AS n FROM readings_h)
WHERE n <= 96"""))
def last_n_per_region(spark, folder):
    return rounded(evaluate.last_rows(readings_h(spark, folder).select("region", "date_time", "pm2_5"), 96), "pm2_5")


@query("first_predictions", with_views(EV, RH, PREDS, tail=f"""
SELECT region, date_time, {s6('actual_pm2_5', 'actual_pm2_5')}, {s6('naive_last_pred_pm2_5', 'naive_last_pred_pm2_5')}
FROM wide WHERE split = 'test' ORDER BY region, date_time LIMIT 500"""))
def first_predictions(spark, folder):
    test = wide_preds(spark, folder).where("split = 'test'").select(
        "region", "date_time", "actual_pm2_5", "naive_last_pred_pm2_5")
    return rounded(evaluate.first_predictions(test, 500), "actual_pm2_5", "naive_last_pred_pm2_5")


@query("median_baseline", with_views(EV, RH, PREDS, "m AS (SELECT target, median(actual) AS v FROM preds WHERE split = 'train' AND strategy = 'naive_last' GROUP BY 1)", tail="""
SELECT split, target, round(sqrt(avg((actual - v) ** 2)) + 1e-9, 6) AS rmse, round(avg(abs(actual - v)) + 1e-9, 6) AS mae, count(*) AS rows
FROM preds JOIN m USING (target) WHERE strategy = 'naive_last' AND split <> 'train' AND actual IS NOT NULL GROUP BY 1, 2"""))
def median_baseline(spark, folder):
    wide = wide_preds(spark, folder)
    actual = {t: f"actual_{t}" for t in K.TARGETS}
    train = wide.where("split = 'train'").select(*[F.col(c).alias(t) for t, c in actual.items()])
    medians = models.median_baseline(train, K.TARGETS)
    guessed = wide.where("split <> 'train'").withColumns({f"_m_{t}": F.lit(medians[t]).cast("double") for t in K.TARGETS})
    long = evaluate.long_predictions(guessed, {"baseline_median": {t: f"_m_{t}" for t in K.TARGETS}}, actual)
    out = evaluate.regression_metrics(long, ["split", "target"]).drop("r2")
    return rounded(out, "rmse", "mae")


# --- lookups ---------------------------------------------------------------

@query("best_strategy_lookup", with_views(EV, RH, PREDS, METRICS, _BEST, tail="""
SELECT k.region, k.target, k.rows, CASE WHEN b.strategy = 'naive_last' THEN 'naive_last' WHEN starts_with(b.strategy, 'single') THEN 'single_target' ELSE 'multi_output' END AS strategy
FROM (SELECT region, target, count(*) AS rows FROM preds GROUP BY 1, 2) k LEFT JOIN best b USING (region, target)"""))
def best_strategy_lookup(spark, folder):
    best = evaluate.best_strategies(metrics(spark, folder))
    keys = preds(spark, folder).groupBy("region", "target").agg(F.count(F.lit(1)).alias("rows"))
    return selector.lookup_best(keys, best, candidates=["naive_last"]).select("region", "target", "rows", "strategy")


_OWN = {("PM2.5", "AIIMS"), ("PM2.5", "IGKV"), ("PM10", "IGKV"), ("PM10", "AIIMS"), ("PM10", "SILTARA"),
        ("SO2", "BHATAGAON"), ("SO2", "SILTARA")}
_ASKED = ("pm2_5", "PM10", "so2", "ozone")


def _selector_sql():
    own = " OR ".join(f"(label = '{t}' AND region = '{r}')" for t, r in sorted(_OWN))
    texts = []
    for t, kinds in K.SELECTOR_TEXTS.items():
        for kind in ("region", "global"):
            texts.append((t, kind, *kinds[kind]))
    rows = ", ".join("('" + "', '".join(x) + "')" for x in texts)
    model, strategy, reason = K.SELECTOR_FALLBACK
    return f"""
SELECT event_id, CASE WHEN s.label IS NULL THEN '{model}' WHEN a.kind = 'region' THEN region || '_' || replace(a.label, '.', '') || '_Model'
    ELSE 'global_' || lower(replace(a.label, '.', '')) || '_model' END AS model,
  coalesce(s.strategy, '{strategy}') AS strategy, coalesce(s.reason, '{reason}') AS reason
FROM (SELECT event_id, region, label, CASE WHEN {own} THEN 'region' ELSE 'global' END AS kind FROM asked) a
LEFT JOIN (VALUES {rows}) s(label, kind, strategy, reason) ON a.label = s.label AND a.kind = s.kind"""


@query("model_selector", with_views(EV, f"""asked AS (
  SELECT event_id, region, CASE list_extract({list(_ASKED)!r}, CAST(event_id % 4 AS INT) + 1) WHEN 'pm2_5' THEN 'PM2.5' WHEN 'PM10' THEN 'PM10' WHEN 'so2' THEN 'SO2' ELSE 'OZONE' END AS label
  FROM ev)""", tail=_selector_sql()))
def model_selector(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    target = F.element_at(F.array(*[F.lit(a) for a in _ASKED]), (F.pmod("event_id", F.lit(4)) + 1).cast("int"))
    return ev.select("event_id", F.inline(F.array(selector.model_selector(F.lower("region"), target))))


@query("compact_report", with_views(EV, RH, PREDS, METRICS, tail="""
SELECT array_to_string(list_sort(list(DISTINCT target)), ',') AS targets, count(DISTINCT strategy) AS strategies, count(*) AS rows,
  (SELECT strategy FROM metrics WHERE is_overall = 1 AND split = 'test' GROUP BY 1 ORDER BY avg(rmse), avg(mae), strategy LIMIT 1) AS first_strategy
FROM metrics WHERE is_overall = 1 AND split = 'test'"""))
def compact_report(spark, folder):
    report = reports.compact_report(evaluate.overall(metrics(spark, folder)))
    return report.select(
        F.array_join("targets", ",").alias("targets"), F.size("model_comparison").cast("bigint").alias("strategies"),
        F.size("test_metrics").cast("bigint").alias("rows"), F.col("model_comparison")[0]["strategy"].alias("first_strategy"))
