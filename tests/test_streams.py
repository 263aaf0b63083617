"""Streams over several micro-batches give the batch result."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sensorspark.functions.times import floor_to
from sensorspark.operators import alerts, merge
from sensorspark.streaming import jobs

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "region string, date_time timestamp_ntz, pm2_5 double, pm10 double"


def write_batches(spark, path, batches, schema=SCHEMA):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}")


def readings(hours=200, seed=4):
    rng = random.Random(seed)
    return [(r, T0 + dt.timedelta(hours=i), None if rng.random() < 0.2 else rng.gauss(50, 10) * (3 if rng.random() < 0.05 else 1), rng.gauss(5, 1))
            for i in range(hours) for r in ("A", "B") if rng.random() < 0.9]


def values(df):
    return sorted((r["region"], r["date_time"], r["pollutant"], round(r["z_score"], 9)) for r in df.collect())


def test_alert_job_over_batches(spark, tmp_path):
    rows = readings()
    batches = [[r for r in rows if a <= (r[1] - T0).total_seconds() / 3600 < a + 25] for a in range(0, 200, 25)]
    source = str(tmp_path / "in")
    write_batches(spark, source, batches)
    job = jobs.RollingAlertJob(spark, str(tmp_path / "job"), ["pm2_5", "pm10"], window=24, threshold=2.0)
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1)
    job.start(stream, str(tmp_path / "cp")).awaitTermination()
    batch = alerts.rolling_zscore_alerts(spark.createDataFrame(rows, SCHEMA), ["pm2_5", "pm10"], 24, 2.0)
    assert values(job.alerts()) == values(batch) and batch.count() > 10


def test_alert_job_sets_late_rows_aside_and_repeats_safely(spark, tmp_path):
    rows = readings(60)
    first = spark.createDataFrame([r for r in rows if r[1] < T0 + dt.timedelta(hours=40)], SCHEMA)
    second = spark.createDataFrame([r for r in rows if r[1] >= T0 + dt.timedelta(hours=40)] + [("A", T0, 1e9, 1.0), ("C", T0, 1.0, 1.0)], SCHEMA)
    job = jobs.RollingAlertJob(spark, str(tmp_path / "job"), ["pm2_5"], window=24, threshold=2.0)
    job.process(first, 0)
    job.process(second, 1)
    once = values(job.alerts())
    job.process(second, 1)
    assert values(job.alerts()) == once
    late = spark.read.parquet(str(tmp_path / "job" / "late"))
    assert [(r["region"], r["pm2_5"]) for r in late.collect()] == [("A", 1e9)]
    want = alerts.rolling_zscore_alerts(spark.createDataFrame(rows + [("C", T0, 1.0, 1.0)], SCHEMA), ["pm2_5"], 24, 2.0)
    assert once == values(want)


def test_score_stream_equals_batch(spark, tmp_path):
    rows = readings(30)
    source = str(tmp_path / "in")
    write_batches(spark, source, [rows[:20], rows[20:]])
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1)
    out = jobs.run_to_table(jobs.score_stream(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    batch = jobs.score_stream(spark.createDataFrame(rows, SCHEMA))
    pick = ["region", "date_time", "pm2_5_forecast", "risk.category", F.size("anomaly_alerts")]
    assert sorted(map(str, out.select(*pick).collect())) == sorted(map(str, batch.select(*pick).collect()))


RAW = "region string, granularity string, date_time timestamp_ntz, pm2_5 double, pm10 double, path string"


def test_clean_stream_keeps_the_fullest_row(spark, tmp_path):
    rows = [("A", "hourly", T0 + dt.timedelta(minutes=m), float(m), None if m % 20 else 1.0, f"p{m:05d}") for m in range(0, 600, 5)]
    flush = [("A", "hourly", T0 + dt.timedelta(days=2), 0.0, None, "z")]
    late = [("A", "hourly", T0, 9.0, 9.0, "a")]
    source = str(tmp_path / "in")
    write_batches(spark, source, [rows[:60], rows[60:], flush, late], RAW)
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1)
    out = jobs.run_to_table(jobs.clean_stream(stream, ["pm2_5", "pm10"], "1 hour", ties=["path"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    keyed = spark.createDataFrame(rows, RAW).withColumnRenamed("path", "source_relative_path").withColumn("source_sheet", F.lit("1"))
    batch = merge.best_row_per_key(merge.align_rows(keyed), metrics=["pm2_5", "pm10"])
    got = sorted((r["date_time"], r["pm2_5"], r["selected_row_non_null_score"]) for r in out.collect())
    assert got == sorted((r["date_time"], r["pm2_5"], r["selected_row_non_null_score"]) for r in batch.collect())
    assert sum(r["source_row_count"] for r in out.collect()) == len(rows)


def test_mean_stream_equals_batch(spark, tmp_path):
    rows = [("AB"[m % 2], T0 + dt.timedelta(minutes=m * 7), float(m), 1.0) for m in range(200)]
    flush = [("A", T0 + dt.timedelta(days=9), 0.0, 0.0)]
    source = str(tmp_path / "in")
    write_batches(spark, source, [rows[:90], rows[90:], flush])
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1)
    out = jobs.run_to_table(jobs.mean_stream(stream, ["pm2_5"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    batch = spark.createDataFrame(rows, SCHEMA).groupBy("region", floor_to(F.col("date_time"), 3600).alias("date_time")).agg(F.avg("pm2_5").alias("pm2_5"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def dedupe_batch(spark, rows):
    keyed = spark.createDataFrame(rows, RAW).withColumnRenamed("path", "source_relative_path").withColumn("source_sheet", F.lit("1"))
    best = merge.best_row_per_key(merge.align_rows(keyed), metrics=["pm2_5", "pm10"])
    counts = merge.align_rows(keyed).groupBy("region", "granularity", "date_time").count().withColumnRenamed("count", "n")
    joined = best.join(counts, ["region", "granularity", "date_time"])
    return sorted((r["region"], r["date_time"], r["pm2_5"], r["selected_row_non_null_score"], r["n"]) for r in joined.collect())


def dedupe_job(job):
    out = job.closed().unionByName(job.open())
    return sorted((r["region"], r["date_time"], r["pm2_5"], r["selected_row_non_null_score"], r["source_row_count"]) for r in out.collect())


def test_clean_job_over_six_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("AAAB"), "hourly", T0 + dt.timedelta(minutes=m), float(m), None if m % 3 else 1.0, f"p{m:05d}") for m in range(0, 3000, 5)]
    rows += [("A", "hourly", T0 + dt.timedelta(hours=20), float(i), 1.0, f"hot{i:04d}") for i in range(900)]
    rows.sort(key=lambda r: r[2])
    parts = [rows[i * len(rows) // 6:(i + 1) * len(rows) // 6] for i in range(6)]
    late = [("A", "hourly", T0, 9.0, 9.0, "a"), ("B", "hourly", T0, None, None, "b"), ("B", "hourly", None, 1.0, 1.0, "c")]
    source, place, checkpoint = str(tmp_path / "in"), str(tmp_path / "job"), str(tmp_path / "cp")

    def run():
        job = jobs.CleanJob(spark, place, ["pm2_5", "pm10"], 3600, ties=["path"])
        schema = spark.read.parquet(source).schema
        job.start(jobs.read_stream(spark, source, schema, max_files=1), checkpoint).awaitTermination()
        return job

    write_batches(spark, source, parts[:4], RAW)
    job = run()
    assert dedupe_job(job) == dedupe_batch(spark, [r for p in parts[:4] for r in p]) and job.open().count() > 0
    write_batches(spark, source, [*parts[4:], late], RAW)
    job = run()
    assert dedupe_job(job) == dedupe_batch(spark, rows)
    assert sorted(r["path"] for r in job.late(RAW).collect()) == ["a", "b"]
    last = job._last("keys")
    again = spark.createDataFrame(late, RAW)
    job.process(again, last)  # a batch that is repeated changes nothing
    assert dedupe_job(job) == dedupe_batch(spark, rows) and job.late(RAW).count() == 2
    job.process(spark.createDataFrame([], RAW), last + 1)
    assert dedupe_job(job) == dedupe_batch(spark, rows)


def test_clean_job_without_rows(spark, tmp_path):
    job = jobs.CleanJob(spark, str(tmp_path / "job"), ["pm2_5", "pm10"], ties=["path"])
    job.process(spark.createDataFrame([], RAW), 0)
    assert job.closed().count() == job.open().count() == job.late(RAW).count() == 0
    assert job.open().columns == ["region", "granularity", "date_time", "source_row_count", "selected_row_non_null_score", "path", "pm2_5", "pm10"]


def test_stateful_alerts_over_six_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["A", "A", "B"]), T0 + dt.timedelta(minutes=7 * m), None if m % 11 == 0 else rng.gauss(50, 5) * (4 if m % 131 == 0 else 1), 1.0)
            for m in range(1500)]
    parts = [rows[i * 250:(i + 1) * 250] for i in range(6)]
    source, place = str(tmp_path / "in"), str(tmp_path)
    write_batches(spark, source, parts[:3])
    stream = jobs.with_end(jobs.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1), place)
    alarms = jobs.stateful_alerts(stream, ["pm2_5", "pm10"], window=24, threshold=2.0)
    run = lambda: jobs.run_to_table(alarms, f"{place}/out", f"{place}/cp")
    first = run().count()
    write_batches(spark, source, parts[3:])
    assert run().count() > first > 0
    jobs.mark_end(stream, place, f"{place}/cp", 3 * 3600)
    got = run()
    means = spark.createDataFrame(rows, SCHEMA).groupBy("region", floor_to(F.col("date_time"), 3600).alias("date_time")).agg(
        F.avg("pm2_5").alias("pm2_5"), F.avg("pm10").alias("pm10"))
    want = alerts.rolling_zscore_alerts(means, ["pm2_5", "pm10"], 24, 2.0)
    assert values(got) == values(want) and len(values(want)) > 5
    # What comes after the end mark is late: dropped, and counted in the progress of the query.
    write_batches(spark, source, [[("A", T0, 1e9, 1.0)]])
    query = alarms.writeStream.format("parquet").option("checkpointLocation", f"{place}/cp").trigger(availableNow=True).start(f"{place}/out")
    query.awaitTermination()
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 1
    assert values(run()) == values(want)


def test_open_hours_are_given_out_once_over_two_runs(spark, tmp_path):
    rows = [("AB"[m % 2], T0 + dt.timedelta(minutes=m * 7), float(m % 50) + 200.0 * (m % 97 == 0), 1.0) for m in range(1200)]
    rows += [("A", rows[-1][1], float(m), 1.0) for m in range(400)]
    source, place, checkpoint = str(tmp_path / "in"), str(tmp_path / "job"), str(tmp_path / "cp")
    job = jobs.RollingAlertJob(spark, place, ["pm2_5"], window=24, threshold=1.5)
    for part in (rows[:700], rows[700:]):
        write_batches(spark, source, [part])
        schema = spark.read.parquet(source).schema
        job.start(jobs.mean_stream(jobs.read_stream(spark, source, schema, max_files=1), ["pm2_5"]), checkpoint).awaitTermination()
        means = jobs.mean_stream(spark.read.parquet(source), ["pm2_5"])
        assert jobs.still_open(means, checkpoint, 3600).count() > 0
        job.finish(means, checkpoint, 3600)
        assert values(job.alerts()) == values(alerts.rolling_zscore_alerts(means, ["pm2_5"], 24, 1.5))
