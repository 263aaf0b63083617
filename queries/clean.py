"""Text, time and number cleaning, request checks, split and fitted transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import (
    EV, GRID, RAW, RH, TRAIN_END, VALIDATION_END, event_readings, query, r6, raw_readings, readings_h, rounded, s6,
    table, with_views,
)
from sensorspark import constants as K
from sensorspark.functions import numeric, requests, text, times
from sensorspark.operators import features, fitted, grid, merge, split
from sensorspark.operators.quantiles import quantiles
from sensorspark.operators.series import over_series

# --- headers ---------------------------------------------------------------

_HEADS = ("PM2.5 (ug/m3)", "Pm 10", "NOx", "NOX ppb", "DateTime", "Date & Time", "Temp %", "noise", "CO2",
          "windSpeed", "PM_2_5", "  WS(m/s)")


def _headers(spark, folder):
    part = table(spark, folder, "part")
    head = F.element_at(F.array(*[F.lit(h) for h in _HEADS]), (F.pmod("p_partkey", F.lit(len(_HEADS))) + 1).cast("int"))
    raw = F.when(F.col("p_size") % 3 == 0, F.concat(head, F.lit(" "), "p_name")).when(
        F.col("p_size") % 3 == 1, F.concat_ws("&", "p_brand", "p_type")).otherwise(head)
    return part.select(raw.alias("raw_column_name"))


_SNAKE = r"""lower(trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(
  trim(raw_column_name), '([a-z0-9])([A-Z])', '\1_\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'),
  '&', ' and '), '%', ' percent '), '[^A-Za-z0-9]+', '_', 'g'), '_'))"""
_NAMES = "|".join(K.CANONICAL_NAMES)


@query("normalize_headers", f"""
WITH heads AS (
  SELECT CASE p_size % 3
    WHEN 0 THEN list_extract({list(_HEADS)!r}, CAST(p_partkey % {len(_HEADS)} AS INT) + 1) || ' ' || p_name
    WHEN 1 THEN p_brand || '&' || p_type
    ELSE list_extract({list(_HEADS)!r}, CAST(p_partkey % {len(_HEADS)} AS INT) + 1) END AS raw_column_name
  FROM part),
snake AS (SELECT DISTINCT raw_column_name, {_SNAKE} AS s FROM heads),
fixed AS (
  SELECT raw_column_name, replace(replace(replace(replace(s, 'date_and_time', 'date_time'),
    'date_time_stamp', 'date_time'), 'pm_10', 'pm10'), 'pm_2_5', 'pm2_5') AS s FROM snake)
SELECT raw_column_name,
       regexp_replace(s, '^({_NAMES})(_.*|[a-z_]*[a-z][a-z_]*)$', '\\1') AS normalized_column_name
FROM fixed""")
def normalize_headers(spark, folder):
    return _headers(spark, folder).distinct().select(
        "raw_column_name", text.normalize_header(F.col("raw_column_name")).alias("normalized_column_name"))


@query("target_labels", """
SELECT DISTINCT event_type, CASE WHEN t = 'PM25' THEN 'PM2.5' ELSE t END AS target,
       concat_ws('_', 'single_target', event_type) AS strategy
FROM (SELECT event_type, replace(upper(list_extract(['pm2_5', 'PM25', 'pm2.5', ' so2', 'pm10'], CAST(event_id % 5 AS INT) + 1)), '_', '.') AS t0,
             trim(t0) AS t FROM events)""")
def target_labels(spark, folder):
    names = F.array(*[F.lit(n) for n in ("pm2_5", "PM25", "pm2.5", " so2", "pm10")])
    return table(spark, folder, "events").select(
        "event_type", text.target_label(F.element_at(names, (F.pmod("event_id", F.lit(5)) + 1).cast("int"))).alias("target"),
        text.strategy_name(F.lit("single_target"), F.col("event_type")).alias("strategy")).distinct()


@query("normalize_region", """
WITH named AS (
  SELECT event_id, list_extract(['siltara', 'DCR AIIMS', 'igkv dcr', ' Bhatagaon ', 'UNKNOWN'], CAST(event_id % 5 AS INT) + 1) AS raw_region FROM events),
keyed AS (SELECT *, replace(upper(trim(raw_region)), ' ', '_') AS key FROM named),
known AS (
  SELECT *, CASE key WHEN 'BHATAGAON_DCR' THEN 'BHATAGAON' WHEN 'SILTARA_DCR' THEN 'SILTARA'
                     WHEN 'DCR_AIIMS' THEN 'AIIMS' WHEN 'IGKV_DCR' THEN 'IGKV' ELSE key END AS name FROM keyed),
final AS (SELECT raw_region, CASE WHEN name IN ('AIIMS', 'BHATAGAON', 'IGKV', 'SILTARA') THEN name END AS region FROM known)
SELECT raw_region, region, count(*) AS rows,
       CASE region WHEN 'AIIMS' THEN 0 WHEN 'BHATAGAON' THEN 1 WHEN 'IGKV' THEN 2 WHEN 'SILTARA' THEN 3 ELSE 99 END AS rank
FROM final GROUP BY 1, 2""")
def normalize_region(spark, folder):
    names = F.array(*[F.lit(n) for n in ("siltara", "DCR AIIMS", "igkv dcr", " Bhatagaon ", "UNKNOWN")])
    raw = F.element_at(names, (F.pmod("event_id", F.lit(5)) + 1).cast("int"))
    named = table(spark, folder, "events").select(raw.alias("raw_region"))
    found = named.withColumn("region", text.normalize_region(F.col("raw_region")))
    return found.groupBy("raw_region", "region").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "rank", F.coalesce(text.region_order(F.col("region")), F.lit(99)))


# --- paths -----------------------------------------------------------------

_FOLDERS = ("2023/Sample DCR", "raw/AIIMS DCR/2022", "x/Calibration", "igkv 2021", "Blank/2019", "SILTARA/20 24",
            "monthly/ripor", "bhatagaon/2020x")
_PATHS = f"""paths AS (
  SELECT page_id, '/' || list_extract({list(_FOLDERS)!r}, CAST(page_id % {len(_FOLDERS)} AS INT) + 1) || '/' ||
         regexp_replace(url, '^https?://', '') || '.xlsx' AS path FROM pages)"""


def _paths(spark, folder):
    names = F.array(*[F.lit(n) for n in _FOLDERS])
    return table(spark, folder, "pages").select("page_id", F.concat(
        F.lit("/"), F.element_at(names, (F.pmod("page_id", F.lit(len(_FOLDERS))) + 1).cast("int")), F.lit("/"),
        F.regexp_replace("url", "^https?://", ""), F.lit(".xlsx")).alias("path"))


@query("path_exclusion", with_views(_PATHS, tail="SELECT page_id, CASE "
       + " ".join(f"WHEN contains(lower(path), '{t}') THEN 'Excluded by path token: {t}'" for t in K.EXCLUDED_PATH_TOKENS)
       + " END AS reason FROM paths"))
def path_exclusion(spark, folder):
    return _paths(spark, folder).select("page_id", text.exclusion_reason(F.col("path")).alias("reason"))


@query("region_from_path", with_views(_PATHS, tail=r"""
SELECT page_id, CASE WHEN contains(lower(path), 'aiims') THEN 'AIIMS' WHEN contains(lower(path), 'bhatagaon') THEN 'BHATAGAON'
  WHEN contains(lower(path), 'igkv') THEN 'IGKV' WHEN contains(lower(path), 'siltara') THEN 'SILTARA'
  ELSE upper(trim(regexp_replace(lower(regexp_replace(regexp_extract(path, '([^/]*)/*$', 1), '^(.+)\.[^.]+$', '\1')), '[^a-z0-9]+', '_', 'g'), '_')) END AS region,
  regexp_matches(lower(path), '\.(xlsx|xls|xlsb)$') AS is_workbook
FROM paths"""))
def region_from_path(spark, folder):
    return _paths(spark, folder).select(
        "page_id", text.region_from_path(F.col("path")).alias("region"), text.is_workbook(F.col("path")).alias("is_workbook"))


@query("year_from_path", with_views(_PATHS, tail=r"""
SELECT page_id, CAST(nullif(regexp_extract(path, '(20\d{2})', 1), '') AS INT) AS source_year,
       regexp_extract(path, '([^/]+)/+[^/]*/*$', 1) AS month_folder FROM paths"""))
def year_from_path(spark, folder):
    return _paths(spark, folder).select(
        "page_id", text.year_from_path(F.col("path")).alias("source_year"),
        text.parent_folder(F.col("path")).alias("month_folder"))


# --- times and numbers -----------------------------------------------------

@query("align_granularity", with_views(EV, RAW, tail="SELECT event_id, granularity, date_time FROM aligned"))
def align_granularity(spark, folder):
    return merge.align_rows(raw_readings(spark, folder)).select("event_id", "granularity", "date_time")


_LAYOUTS = ("dd-MM-yyyy HH:mm", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm:ss",
            "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm")
_C_LAYOUTS = ("%d-%m-%Y %H:%M", "%d/%m/%Y %H:%M", "%Y-%m-%d %H:%M:%S", "%d-%m-%Y %H:%M:%S",
              "%d/%m/%Y %H:%M:%S", "%Y-%m-%d %H:%M")
_DIRTY = """dated AS (
  SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INT)) AS t FROM orders),
dirty AS (
  SELECT o_orderkey, CASE o_orderkey % 8 """ + " ".join(
    f"WHEN {i} THEN strftime(t, '{f}')" for i, f in enumerate(_C_LAYOUTS)) + """
    WHEN 6 THEN CAST(CAST(epoch_us(t) - epoch_us(TIMESTAMP '1899-12-30') AS DOUBLE) / 86400000000 AS VARCHAR)
    ELSE 'n/a ' || o_orderkey END AS raw FROM dated)"""


def _dirty_dates(spark, folder):
    key = F.col("o_orderkey")
    moment = F.timestamp_add("MINUTE", F.pmod(key, F.lit(1440)).cast("int"), F.col("o_orderdate"))
    serial = (F.timestamp_diff("MICROSECOND", times.ntz("1899-12-30"), F.col("t")).cast("double")
              / F.lit(86_400_000_000.0)).cast("string")
    orders = table(spark, folder, "orders").select("o_orderkey", moment.alias("t"))
    raw = F.when(key % 8 == 6, serial).when(key % 8 == 7, F.concat(F.lit("n/a "), key.cast("string")))
    for i, layout in enumerate(_LAYOUTS):
        raw = raw.when(key % 8 == i, F.date_format("t", layout))
    return orders.select("o_orderkey", raw.alias("raw"))


@query("parse_dirty_dates", with_views(_DIRTY, tail=f"""
SELECT o_orderkey, coalesce(
  TIMESTAMP '1899-12-30' + to_microseconds(CAST(round(try_cast(raw AS DOUBLE) * 86400000000) AS BIGINT)),
  try_strptime(raw, {list(_C_LAYOUTS)!r})) AS parsed FROM dirty"""))
def parse_dirty_dates(spark, folder):
    return _dirty_dates(spark, folder).select("o_orderkey", times.parse_datetime(F.col("raw")).alias("parsed"))


@query("coerce_iso_dates", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE l_linenumber % 3 WHEN 0 THEN NULL ELSE l_shipdate END AS shipped
FROM lineitem""")
def coerce_iso_dates(spark, folder):
    text_date = F.when(F.col("l_linenumber") % 3 == 0, F.lit("not a date")).when(
        F.col("l_linenumber") % 3 == 1, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format("l_shipdate", "MM/dd/yyyy HH:mm"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", times.coerce_datetime(text_date).alias("shipped"))


@query("numeric_coercion", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE value END AS number,
       CASE WHEN event_id % 6 > 3 THEN value ELSE 0.0 END AS number_or_zero
FROM events""")
def numeric_coercion(spark, folder):
    event = F.col("event_id") % 6
    raw = F.when(event == 0, F.lit("NaN")).when(event == 1, F.lit("-inf")).when(event == 2, F.lit("n.d.")).when(
        event == 3, F.concat(F.col("value").cast("string"), F.lit("d"))).otherwise(
        F.concat(F.lit(" "), F.col("value").cast("string")))
    return table(spark, folder, "events").select(
        "event_id", numeric.to_double(raw).alias("number"), numeric.to_double_or_zero(raw).alias("number_or_zero"))


@query("request_times", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE date_trunc('second', ts) END AS date_time, event_id % 2 = 0 AS rejected
FROM events""")
def request_times(spark, folder):
    raw = F.when(F.col("event_id") % 2 == 0, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, folder, "events").select("event_id", times.request_time(raw).alias("date_time")).withColumn(
        "rejected", F.col("date_time").isNull())


_CYCLES = (("hour", "hour(date_time)", "24"), ("minute", "minute(date_time)", "60"),
           ("day_of_week", "(isodow(date_time) - 1)", "7"), ("month", "month(date_time)", "12"),
           ("day_of_year", "dayofyear(date_time)", "365.25"))


def _cycle_sql(*names):
    return ", ".join(
        s6(f"{f}(2 * pi() * {e} / {p})", f"{n}_{f}") for n, e, p in _CYCLES if n in names for f in ("sin", "cos"))


CALENDAR_SQL = """CAST(year(date_time) AS INT) AS year, CAST(month(date_time) AS INT) AS month, CAST(day(date_time) AS INT) AS day, CAST(hour(date_time) AS INT) AS hour,
  CAST(minute(date_time) AS INT) AS minute, CAST(isodow(date_time) - 1 AS INT) AS day_of_week, CAST(dayofyear(date_time) AS INT) AS day_of_year,
  CAST(weekofyear(date_time) AS INT) AS week_of_year, CAST(isodow(date_time) >= 6 AS INT) AS is_weekend, """ \
    + _cycle_sql("hour", "minute", "day_of_week", "month", "day_of_year")


@query("calendar_cyclic", with_views(EV, tail=f"SELECT event_id, {CALENDAR_SQL} FROM ev"))
def calendar_cyclic(spark, folder):
    ev = event_readings(table(spark, folder, "events")).select("event_id", "date_time")
    out = features.add_calendar(ev).drop("date_time")
    return rounded(out, *[c for c in out.columns if c.endswith(("_sin", "_cos"))])


@query("cyclic_small", with_views(EV, tail="""
SELECT event_id, CAST(hour(date_time) AS INT) AS hour, CAST(isodow(date_time) - 1 AS INT) AS day_of_week, CAST(month(date_time) AS INT) AS month,
  CAST(isodow(date_time) >= 6 AS INT) AS is_weekend, """ + _cycle_sql("hour", "month") + " FROM ev"))
def cyclic_small(spark, folder):
    out = features.add_cyclic(event_readings(table(spark, folder, "events")).select("event_id", "date_time")).drop("date_time")
    return rounded(out, *[c for c in out.columns if c.endswith(("_sin", "_cos"))])


@query("peak_flags", with_views(EV, tail="""
SELECT event_id, CAST(hour(date_time) AS INT) AS hour, CAST(day(date_time) AS INT) AS day, CAST(month(date_time) AS INT) AS month,
  CAST(isodow(date_time) - 1 AS INT) AS day_of_week, CAST(isodow(date_time) >= 6 AS INT) AS is_weekend,
  CAST(hour(date_time) BETWEEN 7 AND 10 AS INT) AS is_morning_peak,
  CAST(hour(date_time) BETWEEN 17 AND 21 AS INT) AS is_evening_peak, """ + _cycle_sql("hour", "month") + " FROM ev"))
def peak_flags(spark, folder):
    out = features.add_peaks(event_readings(table(spark, folder, "events")).select("event_id", "date_time")).drop("date_time")
    return rounded(out, *[c for c in out.columns if c.endswith(("_sin", "_cos"))])


@query("wind_vector", with_views(EV, tail=f"SELECT event_id, {s6('sin(radians(wd))', 'wd_sin')}, {s6('cos(radians(wd))', 'wd_cos')} FROM ev"))
def wind_vector(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    return ev.select("event_id", *[r6(c).alias(n) for n, c in times.wind_vector(F.col("wd")).items()])


# --- requests --------------------------------------------------------------

_REQUESTS = """req AS (
  SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'NOWHERE' ELSE region END AS region,
         list_extract(['best', 'multi_output', 'single_target', 'magic'], CAST(event_id % 4 AS INT) + 1) AS strategy,
         pm2_5, CASE WHEN event_id % 2 = 0 THEN value END AS pm25, pm10 - 20 AS pm10, temp, hum, ws,
         CASE WHEN event_id % 5 <> 0 THEN wd + 10 END AS wind_direction
  FROM ev)"""


def _requests(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    event = F.col("event_id")
    strategies = F.array(*[F.lit(s) for s in ("best", "multi_output", "single_target", "magic")])
    return ev.select(
        "event_id", F.when(event % 9 == 0, F.lit("NOWHERE")).otherwise(F.col("region")).alias("region"),
        F.element_at(strategies, (F.pmod(event, F.lit(4)) + 1).cast("int")).alias("strategy"),
        "pm2_5", F.when(event % 2 == 0, F.col("value")).alias("pm25"), (F.col("pm10") - 20).alias("pm10"),
        "temp", "hum", "ws", F.when(event % 5 != 0, F.col("wd") + 10).alias("wind_direction"))


@query("reading_bounds_rejects", with_views(EV, _REQUESTS, tail="""
SELECT event_id, concat_ws(',', CASE WHEN pm2_5 < 0 THEN 'pm2_5' END, CASE WHEN pm25 < 0 THEN 'pm25' END,
  CASE WHEN pm10 < 0 THEN 'pm10' END, CASE WHEN temp < 0 OR temp > 60 THEN 'temp' END,
  CASE WHEN hum < 0 OR hum > 100 THEN 'hum' END, CASE WHEN ws < 0 THEN 'ws' END,
  CASE WHEN wind_direction < 0 OR wind_direction > 360 THEN 'wind_direction' END,
  CASE WHEN region = 'NOWHERE' THEN 'region' END, CASE WHEN strategy = 'magic' THEN 'strategy' END) AS violations
FROM req"""))
def reading_bounds_rejects(spark, folder):
    req = _requests(spark, folder)
    return req.select("event_id", F.array_join(requests.violations(req), ",").alias("violations"))


@query("reading_defaults", with_views(EV, _REQUESTS, tail=f"""
SELECT event_id, {s6('coalesce(pm2_5, pm25, 38.0)', 'pm2_5')}, {s6('coalesce(pm10, 112.0)', 'pm10')}, 18.0::DOUBLE AS so2,
  {s6('coalesce(temp, 31.0)', 'temp')}, {s6('coalesce(hum, 58.0)', 'hum')}, {s6('coalesce(ws, 3.2)', 'ws')},
  {s6('coalesce(wind_direction, 180.0)', 'wd')}, CAST(NULL AS DOUBLE) AS benz,
  {s6('coalesce(pm2_5, pm25)', 'pm2_5_strict')}
FROM req"""))
def reading_defaults(spark, folder):
    req = _requests(spark, folder)
    filled, strict = requests.reading_columns(req, coalesce_nulls=True), requests.reading_columns(req)
    names = ("pm2_5", "pm10", "temp", "hum", "ws", "wd")
    return req.select("event_id", *[r6(filled[n]).alias(n) for n in names], filled["so2"].alias("so2"),
                      filled["benz"].alias("benz"), r6(strict["pm2_5"]).alias("pm2_5_strict"))


# --- base load, features, split --------------------------------------------

@query("base_load_filter", with_views(EV, RAW, tail="""
SELECT event_id, region, date_time, CASE WHEN abs(big) < 1000000 THEN round(big, 6) END AS pm2_5, pm10
FROM (SELECT a.event_id, a.region, a.date_time, CASE WHEN a.event_id % 50 = 0 THEN a.pm2_5 * 1e6 ELSE a.pm2_5 END AS big, round(a.pm10, 6) AS pm10, r.date_time AS t
      FROM aligned a JOIN raw r ON a.event_id = r.event_id WHERE a.granularity = 'hourly')
WHERE t >= TIMESTAMP '2024-01-03 00:00:00' AND t <= TIMESTAMP '2024-01-28 12:00:00'"""))
def base_load_filter(spark, folder):
    raw = raw_readings(spark, folder)
    spoiled = raw.withColumn("pm2_5", F.when(F.col("event_id") % 50 == 0, F.col("pm2_5") * 1e6).otherwise(F.col("pm2_5")))
    base = split.base_load(spoiled, "hourly", "2024-01-03 00:00:00", "2024-01-28 12:00:00")
    return base.select("event_id", "region", "date_time", F.round("pm2_5", 6).alias("pm2_5"), F.round("pm10", 6).alias("pm10"))


@query("impossible_values", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_extendedprice * 20 < 1000000 THEN round(l_extendedprice * 20, 4) END AS price
FROM lineitem""")
def impossible_values(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") * 20).alias("price"))
    return split.remove_implausible(items, ["price"]).withColumn("price", F.round("price", 4))


@query("missing_indicators", with_views(EV, RH, tail="""
SELECT region, date_time, CAST(pm2_5 IS NULL AS INT) AS is_missing_pm2_5, CAST(so2 IS NULL AS INT) AS is_missing_so2 FROM readings_h"""))
def missing_indicators(spark, folder):
    out = features.add_missing_indicators(readings_h(spark, folder), ["pm2_5", "so2", "not_there"])
    return out.select("region", "date_time", "is_missing_pm2_5", "is_missing_so2")


@query("region_one_hot", with_views(EV, RH, tail="SELECT region, date_time, " + ", ".join(
    f"CAST(region = '{r}' AS INT) AS region_{r}" for r in K.REGIONS) + " FROM readings_h"))
def region_one_hot(spark, folder):
    rows = readings_h(spark, folder).select("region", "date_time")
    return features.add_region_one_hot(rows, features.learn_regions(rows))


def model_rows(spark, folder):
    """Grid with targets and split label."""
    frame = grid.regular_grid(readings_h(spark, folder), "hourly")
    frame = over_series(frame, lambda w: features.target_columns(w, K.TARGETS, 1), step=3600, ahead=1)
    return frame.withColumn("split", split.split_label(K.TARGETS, TRAIN_END, VALIDATION_END))


SPLIT = """leads AS (
  SELECT *, lead(observed_row) OVER w AS observed_future, lead(pm2_5) OVER w AS target_pm2_5,
         lead(pm10) OVER w AS target_pm10, lead(so2) OVER w AS target_so2
  FROM grid WINDOW w AS (PARTITION BY region ORDER BY date_time)),
labelled AS (
  SELECT *, CASE WHEN observed_row = 1 AND observed_future = 1 AND target_pm2_5 IS NOT NULL
                      AND target_pm10 IS NOT NULL AND target_so2 IS NOT NULL THEN
    CASE WHEN date_time <= TIMESTAMP '""" + TRAIN_END + """' THEN 'train'
         WHEN date_time <= TIMESTAMP '""" + VALIDATION_END + """' THEN 'validation' ELSE 'test' END END AS split
  FROM leads)"""


@query("chronological_split", with_views(EV, RH, GRID, SPLIT, tail="SELECT region, date_time, split FROM labelled"))
def chronological_split(spark, folder):
    return model_rows(spark, folder).select("region", "date_time", "split")


@query("split_counts", with_views(EV, RH, GRID, SPLIT, tail="""
SELECT split, region, count(*) AS rows, CAST(grouping(region) AS INT) AS is_total FROM labelled WHERE split IS NOT NULL
GROUP BY GROUPING SETS ((split, region), (split))"""))
def split_counts(spark, folder):
    return split.split_counts(model_rows(spark, folder)).withColumn("is_total", F.col("is_total").cast("int"))


@query("non_null_train_features", with_views(EV, RH, GRID, SPLIT, tail=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS readings FROM labelled WHERE split = 'train' HAVING count({c}) > 0"
    for c in ("pm2_5", "pm10", "so2", "temp", "hum", "ws", "wd"))))
def non_null_train_features(spark, folder):
    frame = model_rows(spark, folder).withColumn("sr", F.lit(None).cast("double"))
    train = frame.where("split = 'train'")
    kept = split.non_null_columns(train, split.feature_columns(frame))
    return train.agg(*[F.count(c).alias(c) for c in kept]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("readings")) for c in kept])))


# --- fitted transforms -----------------------------------------------------

def _clip_sql(c, low, high):
    return f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {low}), {high}) END"


@query("column_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS p, {s6(f'quantile_cont({c}, {p})', 'bound')} FROM lineitem"
    for c in ("l_quantity", "l_extendedprice") for p in (0.005, 0.5, 0.995)))
def column_quantiles(spark, folder):
    """Exact quantiles by counting, the way used for big tables."""
    items = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    probabilities = [0.005, 0.5, 0.995]
    found = quantiles(items, items.columns, probabilities)
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(probabilities, values)]
    return spark.createDataFrame(rows, "feature string, p double, bound double").withColumn("bound", r6("bound"))


@query("quantile_clip", f"""
WITH b AS (SELECT quantile_cont(l_quantity, 0.005) AS q0, quantile_cont(l_quantity, 0.995) AS q1,
                  quantile_cont(l_extendedprice, 0.005) AS e0, quantile_cont(l_extendedprice, 0.995) AS e1 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {s6('least(greatest(l_quantity, q0), q1)', 'l_quantity')},
       {s6('least(greatest(l_extendedprice, e0), e1)', 'l_extendedprice')} FROM lineitem, b""")
def quantile_clip(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    model = fitted.QuantileClipper(inputCols=["l_quantity", "l_extendedprice"]).fit(items)
    return rounded(model.transform(items), "l_quantity", "l_extendedprice")


@query("iqr_cap", with_views(EV, f"""b AS (SELECT quantile_cont(pm2_5, 0.25) AS a, quantile_cont(pm2_5, 0.75) AS c FROM ev)""", tail=f"""
SELECT event_id, {s6(_clip_sql('pm2_5', 'a - 1.5 * (c - a)', 'c + 1.5 * (c - a)'), 'pm2_5')} FROM ev, b"""))
def iqr_cap(spark, folder):
    ev = event_readings(table(spark, folder, "events")).select("event_id", "pm2_5")
    return rounded(fitted.cap_outliers(ev, ["pm2_5", "absent"]), "pm2_5")


@query("median_impute", with_views(EV, "m AS (SELECT median(pm2_5) AS a, median(ws) AS b FROM ev)", tail=f"""
SELECT event_id, {s6('coalesce(pm2_5, a)', 'pm2_5')}, {s6('coalesce(ws, b)', 'ws')},
       CAST(pm2_5 IS NULL AS DOUBLE) AS missingindicator_pm2_5 FROM ev, m"""))
def median_impute(spark, folder):
    ev = event_readings(table(spark, folder, "events")).select("event_id", "pm2_5", "ws")
    return rounded(fitted.MedianImputer(inputCols=["pm2_5", "ws"]).fit(ev).transform(ev), "pm2_5", "ws")


@query("target_transform_roundtrip", with_views(EV, RH, "b AS (SELECT quantile_cont(pm2_5, 0.995) AS u FROM readings_h)", tail=f"""
SELECT region, date_time, {s6('ln(1 + ' + _clip_sql('pm2_5', '0', 'u') + ')', 'transformed')},
       {s6(_clip_sql('pm2_5', '0', 'u'), 'restored')} FROM readings_h, b"""))
def target_transform_roundtrip(spark, folder):
    rows = readings_h(spark, folder).select("region", "date_time", "pm2_5")
    model = fitted.TargetTransformer(inputCols=["pm2_5"]).fit(rows)
    forward = model.transform(rows)
    both = forward.select("region", "date_time", F.col("pm2_5").alias("transformed"), "pm2_5")
    return rounded(model.inverse(both).withColumnRenamed("pm2_5", "restored"), "transformed", "restored")
