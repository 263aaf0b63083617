"""Registry and the sensor views built from the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions import text
from sensorspark.functions.times import floor_to

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(col: Column | str) -> Column:
    """Six decimals, nudged off exact ties, which differ between engines in the last bit."""
    return F.round((F.col(col) if isinstance(col, str) else col) + F.lit(1e-9), 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    wanted = set(columns)
    return df.select(*[r6(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def s6(expression: str, name: str = "") -> str:
    return f"round({expression} + 1e-9, 6)" + (f" AS {name}" if name else "")


def with_views(*views: str, tail: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + tail


# One reading per event: the event type decides which sensor it belongs to.
_PARTS = {"pm2_5": ("view", 1.0), "pm10": ("click", 2.5), "so2": ("purchase", 0.4),
          "temp": ("signup", 1.0), "hum": ("error", 1.0)}
SENSORS = (*_PARTS, "ws", "wd")


def station(user: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in K.REGIONS]), (F.pmod(user, F.lit(4)) + 1).cast("int"))


def event_readings(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", r"(\d+)", 1).cast("double")
    sensors = [F.when(F.col("event_type") == kind, F.col("value") * factor).alias(name)
               for name, (kind, factor) in _PARTS.items()]
    return events.select("event_id", "user_id", station(F.col("user_id")).alias("region"),
                         F.col("ts").alias("date_time"), *sensors, (k / 10).alias("ws"), (k * 3.6).alias("wd"),
                         "value")


EV = """ev AS (
  SELECT event_id, user_id, ts AS date_time, value, event_type,
         list_extract(['AIIMS', 'BHATAGAON', 'IGKV', 'SILTARA'], CAST(user_id % 4 AS INT) + 1) AS region,
         CASE WHEN event_type = 'view' THEN value END AS pm2_5,
         CASE WHEN event_type = 'click' THEN value * 2.5 END AS pm10,
         CASE WHEN event_type = 'purchase' THEN value * 0.4::DOUBLE END AS so2,
         CASE WHEN event_type = 'signup' THEN value END AS temp,
         CASE WHEN event_type = 'error' THEN value END AS hum,
         CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) / 10 AS ws,
         CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) * 3.6::DOUBLE AS wd
  FROM events)"""


def readings_h(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly means per station, with real gaps and missing sensors."""
    ev = event_readings(table(spark, folder, "events"))
    return ev.groupBy("region", floor_to(F.col("date_time"), 3600).alias("date_time")).agg(
        *[F.avg(c).alias(c) for c in SENSORS])


RH = """readings_h AS (
  SELECT region, date_trunc('hour', date_time) AS date_time,
         """ + ", ".join(f"avg({c}) AS {c}" for c in SENSORS) + """
  FROM ev GROUP BY 1, 2)"""


def readings_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly means in which every observed hour has all sensors, for the forecasters."""
    ev = event_readings(table(spark, folder, "events"))
    hour = floor_to(F.col("date_time"), 3600).alias("date_time")
    return ev.groupBy("region", hour).agg(
        F.avg("value").alias("pm2_5"), F.avg(F.col("value") * 2.5 + F.col("ws")).alias("pm10"),
        F.avg(F.col("ws") * 4).alias("so2"), F.max("ws").alias("temp"), (F.min("wd") / 3.6).alias("hum"),
        F.avg("ws").alias("ws"), F.avg("wd").alias("wd"),
    ).withColumn("granularity", F.lit("hourly"))


def raw_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Unmerged source rows: several per (granularity, timestamp), from several files and sheets."""
    ev = event_readings(table(spark, folder, "events"))
    user, event = F.col("user_id"), F.col("event_id")
    base = F.element_at(F.array(F.lit("Hourly Avg"), F.lit("15 Min Avg"), F.lit("Daily")),
                        (F.pmod(event, F.lit(3)) + 1).cast("int"))
    workbook = F.concat(F.lit("f"), user.cast("string"), F.lit(".xlsx"))
    folder_name = F.concat(F.lit("m"), F.pmod(user, F.lit(12)).cast("string"))
    path = F.concat(F.lit("202"), F.pmod(user, F.lit(5)).cast("string"), F.lit("/"), folder_name, F.lit("/"), workbook)
    return ev.select(
        "event_id", "region", "date_time",
        text.granularity(base, workbook).alias("granularity"),
        F.when(F.col("hum").isNull(), F.col("value")).alias("pm2_5"),
        F.when(event % 2 == 0, F.col("value") * 2.5).alias("pm10"),
        base.alias("time_base"), workbook.alias("source_workbook"), path.alias("source_relative_path"),
        (F.pmod(event, F.lit(31)) + 1).cast("string").alias("source_sheet"),
        folder_name.alias("source_month_folder"), text.year_from_path(path).alias("source_year"),
    )


RAW = """raw0 AS (
  SELECT event_id, region, date_time, value, event_type,
         list_extract(['Hourly Avg', '15 Min Avg', 'Daily'], CAST(event_id % 3 AS INT) + 1) AS time_base,
         'f' || user_id || '.xlsx' AS source_workbook,
         '202' || (user_id % 5) || '/m' || (user_id % 12) || '/f' || user_id || '.xlsx' AS source_relative_path,
         CAST(1 + event_id % 31 AS VARCHAR) AS source_sheet,
         'm' || (user_id % 12) AS source_month_folder,
         CAST('202' || (user_id % 5) AS INT) AS source_year
  FROM ev),
raw AS (
  SELECT event_id, region, date_time, time_base, source_workbook, source_relative_path, source_sheet,
         source_month_folder, source_year,
         CASE WHEN regexp_matches(lower(time_base || ' ' || source_workbook), '15|qua') THEN 'quarter_hourly'
              WHEN regexp_matches(lower(time_base || ' ' || source_workbook), 'hou') THEN 'hourly'
              ELSE 'unknown' END AS granularity,
         CASE WHEN event_type <> 'error' THEN value END AS pm2_5,
         CASE WHEN event_id % 2 = 0 THEN value * 2.5 END AS pm10
  FROM raw0),
aligned AS (
  SELECT * EXCLUDE (date_time),
         CASE granularity
           WHEN 'hourly' THEN make_timestamp(CAST(round_even(CAST(epoch_us(date_time) AS DOUBLE) / 3600000000, 0) AS BIGINT) * 3600000000)
           WHEN 'quarter_hourly' THEN make_timestamp(CAST(round_even(CAST(epoch_us(date_time) AS DOUBLE) / 900000000, 0) AS BIGINT) * 900000000)
           ELSE date_time END AS date_time
  FROM raw)"""

GRID = """spine AS (
  SELECT region, unnest(generate_series(first_hour, last_hour, INTERVAL 1 HOUR)) AS date_time
  FROM (SELECT region, min(date_time) AS first_hour, max(date_time) AS last_hour FROM readings_h GROUP BY 1)),
grid AS (
  SELECT spine.region, spine.date_time, CASE WHEN r.region IS NULL THEN 0 ELSE 1 END AS observed_row,
         """ + ", ".join(f"r.{c}" for c in SENSORS) + """
  FROM spine LEFT JOIN readings_h r ON spine.region = r.region AND spine.date_time = r.date_time)"""

TRAIN_END, VALIDATION_END = "2024-01-20 00:00:00", "2024-01-25 00:00:00"
