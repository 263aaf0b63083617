"""Streaming jobs run over everything available, read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import EV, RAW, RH, event_readings, query, r6, raw_readings, readings_dense, rounded, s6, table, with_views
from queries.forecasts import config
from queries.risk_alerts import RULES
from queries.series import _z_sql
from sensorspark import constants as K
from sensorspark.plans import run_store
from sensorspark.plans.shared import new_path
from sensorspark.streaming import jobs


class _Streamed:
    """Stands in for the session of `table`, so the views read the events as a stream."""

    def __init__(self, spark):
        self.spark, self.read = spark, self

    def parquet(self, path):
        schema = self.spark.read.parquet(path).schema
        return jobs.read_stream(self.spark, path, schema)


@query("stream_risk_scoring", with_views(EV, "readings_h AS (SELECT * FROM ev)", RULES, tail="""
SELECT event_id, region, """ + ", ".join(s6(f"{t}_forecast", f"{t}_forecast") for t in K.TARGETS) + """,
  CASE WHEN pm2_5_forecast > 90 OR pm10_forecast > 250 OR so2_forecast > 40 THEN 'Severe' WHEN pm2_5_forecast > 60 OR pm10_forecast > 160 OR so2_forecast > 28 THEN 'Poor'
       WHEN pm2_5_forecast > 35 OR pm10_forecast > 100 OR so2_forecast > 18 THEN 'Moderate' ELSE 'Good' END AS category,
  concat_ws(',', CASE WHEN temp > 60 THEN 'temp' END, CASE WHEN hum > 100 THEN 'hum' END) AS violations,
  CAST(pm2_5_forecast >= 90 AS INT) + CAST(pm10_forecast >= 250 AS INT) + CAST(so2_forecast >= 40 AS INT) AS alerts
FROM ruled"""))
def stream_risk_scoring(spark, folder):
    arriving = event_readings(table(_Streamed(spark), folder, "events")).drop("value", "user_id")
    scored = jobs.score_stream(arriving).select(
        "event_id", "region", *[r6(f"{t}_forecast").alias(f"{t}_forecast") for t in K.TARGETS],
        F.col("risk.category").alias("category"), F.array_join("violations", ",").alias("violations"),
        F.size("anomaly_alerts").alias("alerts"))
    path = new_path(spark, "stream-scores")
    return jobs.run_to_table(scored, f"{path}/out", f"{path}/checkpoint")


@query("stream_dedupe_window", with_views(EV, RAW, """ranked AS (SELECT *, CAST(pm2_5 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT) AS score, count(*) OVER (PARTITION BY region, granularity, date_time) AS n,
  row_number() OVER (PARTITION BY region, granularity, date_time
    ORDER BY CAST(pm2_5 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT) DESC, source_relative_path, source_sheet, event_id) AS rn FROM aligned)""",
       tail="""SELECT region, granularity, date_time, n AS source_row_count, score AS selected_row_non_null_score, event_id,
  source_relative_path, source_sheet, round(pm2_5, 6) AS pm2_5, round(pm10, 6) AS pm10
FROM ranked WHERE rn = 1"""))
def stream_dedupe_window(spark, folder):
    """Best row per key of the stream: the keys it has closed, and those its state still holds at the end."""
    path = new_path(spark, "stream-clean")
    job = jobs.CleanJob(spark, f"{path}/job", ["pm2_5", "pm10"], 3600, ties=["source_relative_path", "source_sheet", "event_id"])
    job.start(raw_readings(_Streamed(spark), folder), f"{path}/checkpoint").awaitTermination()
    out = job.closed().unionByName(job.open())
    return out.withColumns({"pm2_5": F.round("pm2_5", 6), "pm10": F.round("pm10", 6)})


@query("stream_zscore", with_views(EV, RH, tail=" UNION ALL ".join(_z_sql(t) for t in K.TARGETS)))
def stream_zscore(spark, folder):
    """Hourly means of the stream and alerts against the state of each region; an end mark closes the last hours."""
    path = new_path(spark, "stream-zscore")
    source = event_readings(table(_Streamed(spark), folder, "events")).select("region", "date_time", *K.TARGETS)
    stream = jobs.with_end(source, path)
    alerts = jobs.stateful_alerts(stream, K.TARGETS, "hourly", window=24, threshold=2.0)
    jobs.run_to_table(alerts, f"{path}/out", f"{path}/checkpoint")
    jobs.mark_end(stream, path, f"{path}/checkpoint", 3 * K.STEP_SECONDS["hourly"])
    return rounded(jobs.run_to_table(alerts, f"{path}/out", f"{path}/checkpoint"), "value", "z_score")


@query("stream_model_scoring")
def stream_model_scoring(spark, folder):
    """Arriving readings scored by the stored run's winners of their station; readings out of range are listed instead."""
    path = new_path(spark, "stream-models")
    bundle = run_store.trained(readings_dense(spark, folder), config("random_forest")).bundle
    arriving = event_readings(table(_Streamed(spark), folder, "events")).drop("value", "user_id")
    job = jobs.ModelScoringJob(spark, f"{path}/job", bundle, "best", keep=["event_id"])
    job.start(arriving, f"{path}/checkpoint").awaitTermination()
    shown = [c for t in bundle.targets for c in (f"{t}_forecast", f"{t}_strategy")]
    scored = job.scores().select("event_id", "region", *shown, F.col("risk.category").alias("category"), F.lit("").alias("violations"))
    return scored.unionByName(job.rejects().select("event_id", "region", F.array_join("violations", ",").alias("violations")), allowMissingColumns=True)
