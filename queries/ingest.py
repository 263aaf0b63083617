"""Sheet cells, content copies, merging and combining."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import EV, RAW, RH, event_readings, query, raw_readings, readings_h, station, table, with_views
from sensorspark.functions.numeric import non_null_score
from sensorspark.operators import discovery, evaluate, merge
from sensorspark.plans import flows
from sensorspark.plans.shared import materialize
from sensorspark.sources import sheets

# --- files -----------------------------------------------------------------

_FILES = """files AS (SELECT source || '/' || doc_id || '.xlsx' AS path, md5(text) AS content_md5 FROM documents),
kept AS (SELECT content_md5, arg_min(path, lower(path)) AS kept_path, count(*) AS copies FROM files GROUP BY 1)"""


def _files(spark, folder):
    """Paths and digests of all documents, stored once so that the texts are read a single time."""
    files = table(spark, folder, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".xlsx")).alias("path"),
        F.col("text").alias("content"))
    return materialize(discovery.content_key(files).select("path", "content_md5"), "digests")


@query("content_dedupe", with_views(_FILES, tail="""
SELECT path, 'Exact duplicate of ' || kept_path AS reason FROM files JOIN kept USING (content_md5) WHERE path <> kept_path"""))
def content_dedupe(spark, folder):
    return discovery.duplicate_files(_files(spark, folder))


@query("kept_files", with_views(_FILES, tail="SELECT content_md5, kept_path, copies FROM kept"))
def kept_files(spark, folder):
    return discovery.kept_files(_files(spark, folder))


@query("skip_report", with_views(_FILES, """rejects AS (
  SELECT 'Exact duplicate of ' || kept_path AS reason FROM files JOIN kept USING (content_md5) WHERE path <> kept_path
  UNION ALL SELECT 'Excluded by path token: sample' FROM files WHERE contains(lower('sample/' || path), 'sample') AND contains(path, 'src1/'))""",
       tail="SELECT reason, count(*) AS files FROM rejects GROUP BY 1"))
def skip_report(spark, folder):
    files = _files(spark, folder)
    moved = files.where(F.contains("path", F.lit("src1/"))).withColumn("path", F.concat(F.lit("sample/"), "path"))
    return discovery.skip_report(discovery.duplicate_files(files), discovery.split_excluded(moved)[1])


# --- sheet cells -----------------------------------------------------------
# Workbook = user, sheet = day. Row 5 is the header, row 6 the units, readings follow.

def sheet_cells(spark, folder):
    """The cells as a stored table, which is what the flow starts from: it reads them more than once."""
    return materialize(_event_cells(spark, folder), "cells")


def _event_cells(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    user, day = F.col("user_id"), F.day("date_time")
    workbook = F.concat(F.lit("u"), user.cast("string"), F.lit(" hourly.xlsx"))
    path = F.concat(F.lit("/raw/2024/"), F.col("region"), F.lit("/"), workbook)
    sheet = F.when(user % 10 == 8, F.concat(F.lit("Summary "), day.cast("string"))).when(
        user % 10 == 7, F.concat(day.cast("string"), F.lit(".0"))).otherwise(day.cast("string"))
    keyed = ev.select("region", path.alias("path"), workbook.alias("workbook"), sheet.alias("sheet"), "user_id",
                      "event_id", "date_time", "value", "pm2_5", "ws", "wd")
    stamp = F.when(F.col("event_id") % 11 == 0, F.lit("no date")).when(
        F.col("event_id") % 2 == 0, F.date_format("date_time", "dd-MM-yyyy HH:mm")).otherwise(
        F.date_format("date_time", "yyyy-MM-dd HH:mm:ss"))
    cells = F.array(stamp, F.col("pm2_5").cast("string"), (F.col("value") * 2).cast("string"), F.lit("n.d."),
                    F.col("ws").cast("string"), F.col("wd").cast("string"), F.col("value").cast("string"))
    data = keyed.select("region", "path", "workbook", "sheet", (F.col("event_id") + 10).cast("int").alias("row_idx"),
                        cells.alias("cells"))

    def row(index, *values):
        return F.struct(F.lit(index).alias("row_idx"), F.array(*[F.lit(v) for v in values]).alias("cells"))

    heading = F.when(F.col("_user") % 10 == 9, F.lit("no header here")).otherwise(F.lit("Date & Time"))
    header = F.struct(F.lit(5).alias("row_idx"), F.array(
        heading, *[F.when(F.col("_user") % 10 == 9, F.lit("x")).otherwise(F.lit(n))
                   for n in ("PM2.5 (ug/m3)", "Pm 10", "SO2", "WS(m/s)", "WD", "PM10 raw")]).alias("cells"))
    tops = keyed.groupBy("region", "path", "workbook", "sheet").agg(F.first("user_id").alias("_user")).select(
        "region", "path", "workbook", "sheet", F.inline(F.array(
            F.struct(F.lit(0).alias("row_idx"), F.array(F.lit("Station"), F.concat(F.lit("S"), F.col("_user").cast("string"))).alias("cells")),
            row(2, "Report", "Daily"), row(3, "Time Base", "60 Min"), header, row(6, "", "ug", "ug", "ug", "m", "deg", "ug"))))
    return tops.unionByName(data)


_SHEETS = """keyed AS (
  SELECT *, day(date_time) AS d, 'u' || user_id || ' hourly.xlsx' AS workbook,
         '/raw/2024/' || region || '/u' || user_id || ' hourly.xlsx' AS path,
         CASE user_id % 10 WHEN 8 THEN 'Summary ' || day(date_time) WHEN 7 THEN day(date_time) || '.0'
              ELSE CAST(day(date_time) AS VARCHAR) END AS sheet FROM ev)"""


@query("header_row_detect", with_views(EV, _SHEETS, tail="""
SELECT DISTINCT region, path, sheet, CASE WHEN user_id % 10 = 9 THEN NULL ELSE 5 END AS header_row,
  'S' || user_id AS station_name, 'Daily' AS report_type, '60 Min' AS time_base,
  CASE WHEN user_id % 10 = 9 THEN NULL ELSE 'date_time,pm2_5,pm10,so2,ws,wd,pm10_2' END AS names
FROM keyed WHERE user_id % 10 <> 8"""))
def header_row_detect(spark, folder):
    heads = sheets.sheet_headers(sheet_cells(spark, folder))
    return heads.select("region", "path", "sheet", "header_row", "station_name", "report_type", "time_base",
                        F.array_join("names", ",").alias("names"))


@query("rejected_sheets", with_views(EV, _SHEETS, tail="""
SELECT DISTINCT path, sheet, 'Could not find the data header row.' AS reason FROM keyed WHERE user_id % 10 = 9"""))
def rejected_sheets(spark, folder):
    return sheets.rejected_sheets(sheets.sheet_headers(sheet_cells(spark, folder))).select("path", "sheet", "reason")


@query("load_sheet_cells", with_views(EV, _SHEETS, tail="""
SELECT region, CASE WHEN event_id % 2 = 0 THEN date_trunc('minute', date_time) ELSE date_trunc('second', date_time) END AS date_time,
  CASE WHEN contains(workbook || '60 min', '15') THEN 'quarter_hourly' ELSE 'hourly' END AS granularity,
  round(pm2_5, 6) AS pm2_5, round(value * 2, 6) AS pm10, CAST(NULL AS DOUBLE) AS so2, round(ws, 6) AS ws, round(wd, 6) AS wd,
  round(value, 6) AS pm10_2, 'S' || user_id AS station_name, sheet AS source_sheet, path AS source_relative_path,
  region AS source_month_folder, 2024 AS source_year
FROM keyed WHERE user_id % 10 NOT IN (8, 9) AND event_id % 11 <> 0"""))
def load_sheet_cells(spark, folder):
    out = sheets.load_sheets(sheet_cells(spark, folder))
    six = [F.round(c, 6).alias(c) for c in ("pm2_5", "pm10", "so2", "ws", "wd")]
    return out.select("region", "date_time", "granularity", *six,
                      F.round(F.try_element_at("extra", F.lit("pm10_2")), 6).alias("pm10_2"), "station_name",
                      "source_sheet", "source_relative_path", "source_month_folder", "source_year")


@query("column_mapping", """
SELECT * FROM (VALUES ('Date & Time', 'date_time'), ('PM2.5 (ug/m3)', 'pm2_5'), ('Pm 10', 'pm10'), ('SO2', 'so2'),
  ('WS(m/s)', 'ws'), ('WD', 'wd'), ('PM10 raw', 'pm10_2')) v(raw_column_name, normalized_column_name)
WHERE EXISTS (SELECT 1 FROM events WHERE user_id % 10 NOT IN (8, 9))""")
def column_mapping(spark, folder):
    return sheets.column_mapping(sheets.sheet_headers(sheet_cells(spark, folder)))


@query("ingest_diagnostics", with_views(EV, _SHEETS, tail="""
SELECT 'files' AS section, 'considered' AS name, count(DISTINCT path) AS count FROM keyed HAVING count(*) > 0
UNION ALL SELECT 'files', 'processed', count(DISTINCT path) FROM keyed WHERE user_id % 10 <> 8 HAVING count(*) > 0
UNION ALL SELECT 'skipped_files', 'No daily numeric sheets found.', count(DISTINCT path) FROM keyed WHERE user_id % 10 = 8 HAVING count(*) > 0
UNION ALL SELECT 'sheet_failures', 'Could not find the data header row.', count(DISTINCT path || sheet) FROM keyed WHERE user_id % 10 = 9 HAVING count(*) > 0
UNION ALL SELECT 'column_occurrences', n, count(DISTINCT path || sheet) FROM keyed, (VALUES ('date_time'), ('pm2_5'), ('pm10'), ('so2'), ('ws'), ('wd'), ('pm10_2')) v(n)
  WHERE user_id % 10 NOT IN (8, 9) GROUP BY n"""))
def ingest_diagnostics(spark, folder):
    cells = sheet_cells(spark, folder)
    return sheets.ingest_diagnostics(cells, sheets.sheet_headers(cells))


@query("prepare_flow", with_views(EV, _SHEETS, """loaded AS (
  SELECT region, CASE WHEN contains(workbook, '15') THEN 'quarter_hourly' ELSE 'hourly' END AS granularity,
         CASE WHEN event_id % 2 = 0 THEN date_trunc('minute', date_time) ELSE date_trunc('second', date_time) END AS t, path, sheet
  FROM keyed WHERE user_id % 10 NOT IN (8, 9) AND event_id % 11 <> 0),
al AS (SELECT region, granularity, CASE granularity
  WHEN 'hourly' THEN make_timestamp(CAST(round_even(CAST(epoch_us(t) AS DOUBLE) / 3600000000, 0) AS BIGINT) * 3600000000)
  ELSE make_timestamp(CAST(round_even(CAST(epoch_us(t) AS DOUBLE) / 900000000, 0) AS BIGINT) * 900000000) END AS date_time, path FROM loaded)""",
       tail="""SELECT region, granularity, date_time, count(*) AS source_row_count, count(DISTINCT path) AS source_file_count
FROM al GROUP BY ALL"""))
def prepare_flow(spark, folder):
    out = flows.prepare(sheet_cells(spark, folder)).combined
    return out.select("region", "granularity", "date_time", "source_row_count", "source_file_count")


# --- merge -----------------------------------------------------------------

_METRICS = ["pm2_5", "pm10"]
_RANKED = """ranked AS (
  SELECT *, CAST(pm2_5 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT) AS score,
         row_number() OVER (PARTITION BY region, granularity, date_time
           ORDER BY CAST(pm2_5 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT) DESC, source_relative_path, source_sheet, event_id) AS rn
  FROM aligned)"""


def _ordered_join(column):
    return f"""(SELECT region, granularity, date_time, string_agg(v, ' | ' ORDER BY r) AS {column}
  FROM (SELECT region, granularity, date_time, {column} AS v, min(rn) AS r FROM ranked GROUP BY ALL) GROUP BY ALL)"""


_JOINED = ("source_workbook", "source_relative_path", "source_sheet", "source_month_folder")
_SUMMARY = """summary AS (
  SELECT s.*, """ + ", ".join(f"{c}.{c}" for c in _JOINED) + """ FROM (
    SELECT region, granularity, date_time, count(*) AS source_row_count,
           count(DISTINCT source_relative_path) AS source_file_count, arg_min(source_year, rn) AS source_year
    FROM ranked GROUP BY ALL) s """ + " ".join(
    f"JOIN {_ordered_join(c)} {c} USING (region, granularity, date_time)" for c in _JOINED) + ")"


@query("best_row_per_timestamp", with_views(EV, RAW, _RANKED, tail="""
SELECT region, granularity, date_time, event_id, score AS selected_row_non_null_score, source_relative_path, source_sheet,
  round(pm2_5, 6) AS pm2_5, round(pm10, 6) AS pm10 FROM ranked WHERE rn = 1"""))
def best_row_per_timestamp(spark, folder):
    rows = merge.align_rows(raw_readings(spark, folder))
    best = merge.best_row_per_key(rows, metrics=_METRICS)
    return best.select("region", "granularity", "date_time", "event_id", "selected_row_non_null_score",
                       "source_relative_path", "source_sheet", F.round("pm2_5", 6).alias("pm2_5"), F.round("pm10", 6).alias("pm10"))


@query("duplicate_summary", with_views(EV, RAW, _RANKED, _SUMMARY, tail="SELECT * FROM summary"))
def duplicate_summary(spark, folder):
    return merge.duplicate_summary(merge.align_rows(raw_readings(spark, folder)), metrics=_METRICS)


@query("merge_with_lineage", with_views(EV, RAW, _RANKED, _SUMMARY, tail="""
SELECT s.*, CAST(year(date_time) AS INT) AS year, CAST(month(date_time) AS INT) AS month, CAST(day(date_time) AS INT) AS day, CAST(hour(date_time) AS INT) AS hour, CAST(minute(date_time) AS INT) AS minute,
  round(r.pm2_5, 6) AS pm2_5, round(r.pm10, 6) AS pm10, r.time_base, r.score AS selected_row_non_null_score
FROM summary s JOIN (SELECT * FROM ranked WHERE rn = 1) r USING (region, granularity, date_time)"""))
def merge_with_lineage(spark, folder):
    rows = merge.align_rows(raw_readings(spark, folder))
    out = merge.merge_duplicates(rows, metrics=_METRICS, ties=["event_id"])
    return out.withColumns({"pm2_5": F.round("pm2_5", 6), "pm10": F.round("pm10", 6)})


@query("merge_report", with_views(EV, RAW, """groups AS (
  SELECT region, granularity, date_time, count(*) AS n FROM aligned GROUP BY ALL)""", tail="""
SELECT region, count(*) AS rows_after_merge, count(*) FILTER (WHERE n > 1) AS duplicate_timestamp_groups,
  max(n) AS max_rows_combined_per_timestamp, count(*) FILTER (WHERE granularity = 'hourly') AS hourly
FROM groups GROUP BY 1"""))
def merge_report(spark, folder):
    merged = merge.merge_duplicates(merge.align_rows(raw_readings(spark, folder)), metrics=_METRICS)
    return merge.merge_report(merged).select(
        "region", "rows_after_merge", "duplicate_timestamp_groups", "max_rows_combined_per_timestamp",
        F.col("granularity_counts")["hourly"].alias("hourly"))


# --- combine ---------------------------------------------------------------

_COMBINED = """combined AS (
  SELECT 'EVENTS' AS region, date_time, granularity, pm2_5, CAST(NULL AS DOUBLE) AS total FROM aligned
  UNION ALL BY NAME
  SELECT 'ORDERS' AS region, o_orderdate AS date_time, 'hourly' AS granularity, o_totalprice AS total FROM orders)"""


def _combined(spark, folder):
    raw = raw_readings(spark, folder).select("date_time", "granularity", "pm2_5")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("date_time"), F.lit("hourly").alias("granularity"), F.col("o_totalprice").alias("total"))
    return merge.combine_regions({"EVENTS": raw, "ORDERS": orders})


@query("combine_regions_union", with_views(EV, RAW, _COMBINED, tail="""
SELECT region, date_time, granularity, round(pm2_5, 6) AS pm2_5, round(total, 6) AS total FROM combined"""))
def combine_regions_union(spark, folder):
    out = merge.sort_combined(_combined(spark, folder))
    return out.withColumns({"pm2_5": F.round("pm2_5", 6), "total": F.round("total", 6)})


@query("region_summary", with_views(EV, RAW, _COMBINED, tail="""
SELECT region, count(*) AS rows_after_merge, count(*) FILTER (WHERE granularity = 'hourly') AS hourly_rows,
  count(*) FILTER (WHERE granularity = 'quarter_hourly') AS quarter_hourly_rows,
  count(*) FILTER (WHERE granularity = 'unknown') AS unknown_rows FROM combined GROUP BY 1"""))
def region_summary(spark, folder):
    return merge.region_summary(_combined(spark, folder))


@query("region_coverage", with_views(EV, RH, tail="""
SELECT region, count(*) AS rows, min(date_time) AS start_time, max(date_time) AS end_time,
  count(pm2_5) AS pm2_5_non_null, count(pm10) AS pm10_non_null, count(so2) AS so2_non_null FROM readings_h GROUP BY 1"""))
def region_coverage(spark, folder):
    return merge.region_coverage(readings_h(spark, folder))


@query("value_counts_null_group", """
SELECT d.lang, l.quality, count(*) AS rows FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2""")
def value_counts_null_group(spark, folder):
    joined = table(spark, folder, "documents").select("doc_id", "lang").join(
        table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    return merge.value_counts(joined, "lang", "quality")


@query("non_null_scores", with_views(EV, tail="""
SELECT event_id, CAST(pm2_5 IS NOT NULL AS INT) + CAST(pm10 IS NOT NULL AS INT) + CAST(ws IS NOT NULL AS INT) AS score FROM ev"""))
def non_null_scores(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    return ev.select("event_id", non_null_score(F.col("pm2_5"), F.col("pm10"), F.col("ws")).alias("score"))


@query("missing_names", with_views(EV, tail="""
SELECT region, array_to_string(list_sort(list_filter(['click', 'error', 'purchase', 'signup', 'view', 'zoom'],
  lambda n: NOT list_contains(present, n))), ',') AS missing
FROM (SELECT region, list(DISTINCT event_type) AS present FROM ev GROUP BY 1)"""))
def missing_names(spark, folder):
    ev = table(spark, folder, "events")
    present = ev.groupBy(station(F.col("user_id")).alias("region")).agg(F.collect_set("event_type").alias("present"))
    names = ("click", "error", "purchase", "signup", "view", "zoom")
    return present.select("region", F.array_join(evaluate.missing_names(names, F.col("present")), ",").alias("missing"))


@query("distinct_regions", with_views(EV, tail="SELECT DISTINCT region FROM ev"))
def distinct_regions(spark, folder):
    return evaluate.distinct_sorted(event_readings(table(spark, folder, "events")), "region")
