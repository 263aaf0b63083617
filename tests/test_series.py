import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.operators import alerts, features, grid, split
from sensorspark.operators.series import _row_chunks, over_series

START = dt.datetime(2024, 1, 1)


def irregular(spark, seed=3, rows=1500, regions=("A", "B", "C")):
    """Interleaved, gappy rows; most of them belong to one region, many to one day."""
    rng = random.Random(seed)
    seen, data = set(), []
    while len(data) < rows:
        region = rng.choices(regions, [8, 1, 1])[0]
        minute = rng.randrange(1440) if rng.random() < 0.4 else rng.randrange(60 * 24 * 90)
        if (region, minute) in seen:
            continue
        seen.add((region, minute))
        data.append((region, START + dt.timedelta(minutes=minute), None if rng.random() < 0.2 else rng.random() * 100))
    return spark.createDataFrame(data, "region string, date_time timestamp_ntz, x double")


def windows(w):
    out = {"lag_3": F.lag("x", 3).over(w), "lead_2": F.lead("x", 2).over(w)}
    frame = w.rowsBetween(-20, -1)
    out["mean"] = F.when(F.count("x").over(frame) >= 5, F.avg("x").over(frame))
    return out


def rows_of(df):
    return {(r["region"], r["date_time"]): tuple(None if v is None else round(v, 9) for v in r[2:]) for r in df.collect()}


@pytest.mark.parametrize("per_chunk", [20, 37, 400, 100_000])
def test_row_chunks_equal_the_plain_window(spark, per_chunk):
    df = irregular(spark)
    plain = df.select("*", *[c.alias(n) for n, c in windows(Window.partitionBy("region").orderBy("date_time")).items()])
    cut = over_series(df, windows, back=20, ahead=2, rows_per_chunk=per_chunk)
    assert cut.count() == df.count()
    assert rows_of(cut.select(plain.columns)) == rows_of(plain)


def test_chunks_are_bounded_whatever_the_region(spark):
    """One region holds most rows and one day holds many, yet a chunk stays near its size."""
    df = irregular(spark, rows=4000)
    per_chunk, back, ahead = 100, 20, 2
    busiest = df.groupBy("region", F.floor(F.unix_date(F.col("date_time").cast("date")) * 24 + F.hour("date_time"))).count() \
        .agg(F.max("count")).first()[0]
    cut = _row_chunks(df, "region", "date_time", 3600, back, ahead, per_chunk)
    sizes = [r["count"] for r in cut.groupBy("region", "_chunk").count().collect()]
    assert len(sizes) > 30 and max(sizes) <= per_chunk + back + ahead + 4 * busiest
    assert cut.where("_own").count() == 4000


@pytest.mark.parametrize("per_chunk", [20, 64, 5000])
def test_grid_chunks_equal_the_plain_window(spark, per_chunk):
    hours = spark.range(700).select(
        F.when(F.col("id") % 3 == 0, F.lit("B")).otherwise(F.lit("A")).alias("region"),
        F.timestamp_add("HOUR", (F.col("id") / 3).cast("int") + F.when(F.col("id") % 3 == 2, 300).otherwise(0),
                        F.lit(START).cast("timestamp_ntz")).alias("date_time"),
        F.when(F.col("id") % 7 != 0, F.rand(1) * 50).alias("x"))
    spark_rows = grid.keep_last(hours)
    full = grid.regular_grid(spark_rows, "hourly").select("region", "date_time", "x")
    plain = full.select("*", *[c.alias(n) for n, c in windows(Window.partitionBy("region").orderBy("date_time")).items()])
    cut = over_series(full, windows, step=3600, back=20, ahead=2, rows_per_chunk=per_chunk)
    assert rows_of(cut.select(plain.columns)) == rows_of(plain)


def test_one_window_and_one_extra_exchange(spark):
    base = spark.createDataFrame([("A", START, 1.0)], "region string, date_time timestamp_ntz, pm2_5 double")
    out = over_series(base, lambda w: {
        **features.lag_columns(w, ["pm2_5"], [1, 3]), **features.rolling_columns(w, ["pm2_5"], [3, 6]),
        "next": F.lead("pm2_5", 1).over(w)}, step=3600, back=6, ahead=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1] if "Initial Plan" in plan else plan
    assert initial.count("Window [") == 1 and initial.count("Exchange hashpartitioning") == 1


def test_lags_stay_inside_the_region(spark):
    data = [("AIIMS", START, 10), ("SILTARA", START, 100), ("AIIMS", START + dt.timedelta(hours=1), 20),
            ("SILTARA", START + dt.timedelta(hours=1), 110)]
    out = features.add_group_lags(spark.createDataFrame(data, "region string, date_time timestamp_ntz, pm2_5 int"), ["pm2_5"])
    got = {(r["region"], r["pm2_5"]): r["pm2_5_lag_1"] for r in out.collect()}
    assert got == {("AIIMS", 10): None, ("AIIMS", 20): 10, ("SILTARA", 100): None, ("SILTARA", 110): 100}


def test_rolling_equals_pandas(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(300) < 0.25, np.nan, rng.random(300) * 40)
    pdf = pd.DataFrame({"region": "A", "date_time": pd.date_range(START, periods=300, freq="h"), "pm2_5": x})
    df = spark.createDataFrame([(r.region, r.date_time.to_pydatetime(), None if np.isnan(r.pm2_5) else float(r.pm2_5))
                                for r in pdf.itertuples()], "region string, date_time timestamp_ntz, pm2_5 double")
    out = over_series(df, lambda w: features.rolling_columns(w, ["pm2_5"], [3, 24]), step=3600, back=24, rows_per_chunk=50)
    got = out.orderBy("date_time").toPandas()
    for w in (3, 24):
        rolled = pdf["pm2_5"].shift(1).rolling(w, min_periods=max(2, w // 2))
        for name, want in (("mean", rolled.mean()), ("std", rolled.std())):
            have = got[f"pm2_5_roll_{name}_{w}"].to_numpy(dtype=float)
            np.testing.assert_allclose(have, want.to_numpy(), rtol=1e-9, atol=1e-9)


def test_short_history_needs_full_windows(spark):
    df = spark.createDataFrame([("A", START + dt.timedelta(hours=i), float(i)) for i in range(30)],
                               "region string, date_time timestamp_ntz, x double")
    got = {r["x"]: r for r in features.add_short_history(df, ["x"]).collect()}
    assert got[2.0]["x_rolling_mean_3"] is None and got[3.0]["x_rolling_mean_3"] == 1.0
    assert got[23.0]["x_rolling_min_24"] is None and (got[25.0]["x_rolling_min_24"], got[25.0]["x_rolling_max_24"]) == (1.0, 24.0)


def test_grid_fills_gaps_and_keeps_the_last_row(spark):
    data = [("A", START, 1.0, None, 1), ("A", START, 2.0, None, 2), ("A", START + dt.timedelta(hours=3), 3.0, "S", 1),
            ("A", START + dt.timedelta(hours=5), 4.0, None, 1), ("B", START + dt.timedelta(hours=9), 5.0, None, 1)]
    df = spark.createDataFrame(data, "region string, date_time timestamp_ntz, x double, station_name string, n int") \
        .withColumn("granularity", F.lit("hourly"))
    got = grid.regular_grid(df, "hourly", order=["n"], block=2).orderBy("region", "date_time").collect()
    a = [r for r in got if r["region"] == "A"]
    assert len(a) == 6 and len(got) == 7
    assert [r["observed_row"] for r in a] == [1, 0, 0, 1, 0, 1]
    assert a[0]["x"] == 2.0 and {r["station_name"] for r in a} == {"S"}
    assert got[-1]["station_name"] is None


def test_fill_crosses_chunks_like_pandas(spark):
    rng = random.Random(1)
    names = [rng.choice(["P", "Q"]) if rng.random() < 0.05 else None for _ in range(200)]
    df = spark.createDataFrame([("A", START + dt.timedelta(hours=i), n) for i, n in enumerate(names)],
                               "region string, date_time timestamp_ntz, s string")
    out = grid.fill_series(df, "s", 3600, rows_per_chunk=7).orderBy("date_time").toPandas()["s"].tolist()
    assert out == pd.Series(names, dtype=object).ffill().bfill().tolist()


def test_zscore_without_the_column_is_empty(spark):
    df = irregular(spark, rows=50)
    out = alerts.rolling_zscore_alerts(df, "pm2_5")
    assert out.columns == ["date_time", "region", "pollutant", "value", "z_score"] and out.count() == 0


def test_zscore_without_region_and_with_constant_history(spark):
    df = spark.createDataFrame([(START + dt.timedelta(hours=i), 5.0 if i < 30 else 50.0) for i in range(31)],
                               "date_time timestamp_ntz, x double")
    assert alerts.rolling_zscore_alerts(df, "x").count() == 0
    noisy = df.withColumn("x", F.col("x") + F.hour("date_time") * 0.01)
    assert alerts.rolling_zscore_alerts(noisy, "x", threshold=3.0).count() == 1


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "region string, date_time timestamp_ntz, pm2_5 double")
    assert features.add_group_lags(empty, ["pm2_5"]).count() == 0
    assert grid.regular_grid(empty, "hourly").count() == 0
    single = spark.createDataFrame([("A", START, 1.0)], "region string, date_time timestamp_ntz, pm2_5 double")
    assert features.add_group_lags(single, ["pm2_5"]).first()["pm2_5_lag_1"] is None


def test_feature_contract(spark):
    names = ["year", "hour", "pm2_5", "pm2_5_lag_1", "pm2_5_roll_mean_3", "pm2_5_roll_std_3", "region_AIIMS", "region_SILTARA"]
    df = spark.createDataFrame([("SILTARA", dt.datetime(2025, 11, 20, 18), 55.0)], "region string, date_time timestamp_ntz, pm2_5 double")
    out = features.cold_start_features(df, names)
    assert out.columns == names and out.first()[:] == (2025, 18, 55.0, 55.0, 55.0, 0.0, 0, 1)


def test_cyclic_columns(spark):
    df = spark.createDataFrame([("2025-01-01 23:00:00",)], "date_time string").withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))
    assert {"hour_sin", "hour_cos", "month_sin", "month_cos", "is_weekend"} <= set(features.add_cyclic(df).columns)
    null = df.withColumn("date_time", F.lit(None).cast("timestamp_ntz"))
    assert features.add_cyclic(null).first()["is_weekend"] is None and features.add_peaks(null).first()["is_weekend"] == 0


def test_splits_are_disjoint_and_ordered(spark):
    df = spark.createDataFrame([("A", START + dt.timedelta(hours=i), 1.0, 1.0, 1.0) for i in range(100)],
                               "region string, date_time timestamp_ntz, pm2_5 double, pm10 double, so2 double")
    frame = over_series(grid.regular_grid(df, "hourly"), lambda w: features.target_columns(w, K.TARGETS, 1), step=3600, ahead=1)
    label = split.split_label(train_end="2024-01-02 00:00:00", validation_end="2024-01-03 00:00:00")
    ends = {r["split"]: (r["a"], r["b"], r["n"]) for r in frame.withColumn("split", label).groupBy("split").agg(
        F.min("date_time").alias("a"), F.max("date_time").alias("b"), F.count("*").alias("n")).collect()}
    assert ends["train"][1] < ends["validation"][0] and ends["validation"][1] < ends["test"][0]
    assert ends[None][2] == 1 and sum(e[2] for e in ends.values()) == 100
    counts = split.split_counts(frame.withColumn("split", label))
    assert sum(split.require_splits(counts).values()) == 99
    with pytest.raises(ValueError, match="empty"):
        split.require_splits(counts.where("split <> 'test'"))


def test_base_load_and_columns(spark):
    rows = [("A", "hourly", "2024-01-01 00:10", "5"), ("A", "hourly", "bad", "5"), ("A", "quarter_hourly", "2024-01-01 00:10", "5"),
            ("A", "hourly", "2020-01-01 00:10", "5"), ("A", "hourly", "2024-01-01 03:50", "1000000")]
    df = spark.createDataFrame(rows, "region string, granularity string, date_time string, pm2_5 string")
    got = split.base_load(df, "hourly").orderBy("date_time").collect()
    assert [(r["date_time"].hour, r["pm2_5"]) for r in got] == [(0, 5.0), (4, None)]
    with pytest.raises(split.MissingColumnsError, match="granularity"):
        split.base_load(df.drop("granularity"), "hourly")
    renamed = split.rename_aliases(spark.createDataFrame([(1, 2, 3)], "PM25 int, Humidity int, other int"))
    assert renamed.columns == ["pm2_5", "hum", "other"]


def test_last_row_wins_with_a_map_among_the_columns(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", t, 1.0, {"k": 1.0}), ("A", t, 1.0, {"k": 2.0}), ("A", t, 0.5, {"k": 9.0}), ("B", t, None, None)],
                               "region string, date_time timestamp, v double, extra map<string,double>")
    got = {r["region"]: r for r in grid.keep_last(df).collect()}
    assert got["A"]["extra"] == {"k": 2.0} and got["A"]["v"] == 1.0 and got["B"]["extra"] is None
    assert grid.keep_last(df).columns == df.columns
