"""Merging, sheets, discovery, files and skew."""

import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from sensorspark.operators import discovery, evaluate, merge
from sensorspark.operators.joins import salted_lookup
from sensorspark.plans import flows
from sensorspark.sources import files, sheets

T0 = dt.datetime(2024, 1, 1)
RAW = ("region string, granularity string, date_time timestamp_ntz, pm2_5 double, pm10 double, station_name string, "
       "source_workbook string, source_relative_path string, source_sheet string, source_month_folder string, source_year int")


def raw(spark, *rows):
    return spark.createDataFrame([("A", g, t, a, b, n, p.split("/")[-1], p, s, p.split("/")[0], y)
                                  for g, t, a, b, n, p, s, y in rows], RAW)


def test_best_row_ties(spark):
    df = raw(spark, ("hourly", T0, 1.0, None, "n1", "m2/f.xlsx", "1", None), ("hourly", T0, 2.0, None, "n2", "m1/f.xlsx", "2", 2023),
             ("hourly", T0, 3.0, None, "n3", "m1/f.xlsx", "1", None), ("hourly", T0, None, None, "n4", "m0/f.xlsx", "1", 2020))
    best = merge.best_row_per_key(df).first()
    assert (best["pm2_5"], best["station_name"], best["selected_row_non_null_score"]) == (3.0, "n3", 1)
    merged = merge.merge_duplicates(df).first()
    assert merged["pm2_5"] == 3.0 and merged["station_name"] == "n3"
    assert (merged["source_row_count"], merged["source_file_count"]) == (4, 3)
    assert merged["source_relative_path"] == "m1/f.xlsx | m2/f.xlsx | m0/f.xlsx"
    assert merged["source_sheet"] == "1 | 2" and merged["source_year"] == 2023
    assert (merged["year"], merged["hour"]) == (2024, 0)


def test_align_and_empty(spark):
    df = raw(spark, ("hourly", T0 + dt.timedelta(minutes=30), 1.0, None, None, "m/f", "1", None), ("unknown", T0 + dt.timedelta(minutes=7), 1.0, None, None, "m/f", "1", None),
             ("hourly", None, 1.0, None, None, "m/f", "1", None))
    got = {r["granularity"]: r["date_time"] for r in merge.align_rows(df).collect()}
    assert got == {"hourly": T0, "unknown": T0 + dt.timedelta(minutes=7)}
    assert merge.merge_duplicates(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        merge.combine_regions({})


def test_union_widens(spark):
    a = spark.createDataFrame([(T0, "hourly", 1.0)], "date_time timestamp_ntz, granularity string, pm2_5 double")
    b = spark.createDataFrame([(T0, "unknown", 2.0)], "date_time timestamp_ntz, granularity string, noise double")
    out = merge.combine_regions({"A": a, "B": b})
    assert out.columns == ["region", "date_time", "granularity", "pm2_5", "noise"]
    assert merge.region_summary(out).orderBy("region").collect()[1][:] == ("B", 1, 0, 0, 1)


CELLS = "region string, path string, workbook string, sheet string, row_idx int, cells array<string>"


def sheet(path, name, *rows, start=0):
    return [("AIIMS", path, path.split("/")[-1], name, start + i, list(r)) for i, r in enumerate(rows)]


HEAD = ("Date & Time", "PM2.5", "PM10 (ug)", "SO2", "Temp", "PM10", "Dust level")
TOP = [("Station", " North "), ("", ""), ("Report", "Daily"), ("Base", "15 Min")]


def cells(spark):
    path = "/raw/Jan/2023/AIIMS hourly.xlsx"
    good = sheet(path, "1", *TOP, ("x",), HEAD, ("units", "ug", "ug", "ug", "C", "", ""),
                 ("45292.5", "10", "20", "n.d.", "30", "21", "7"), (None, None, None, None, None, None, None),
                 ("01-01-2024 13:00", "11", "", "2", "31", "22", None), ("garbage", "1", "1", "1", "1", "1", "1"))
    later = sheet(path, "2.0", *TOP, HEAD[:5], ("",) * 5, ("02/01/2024 00:10", "5", "6", "7", "8"))
    no_header = sheet(path, "3", *TOP, ("a", "b"))
    no_time = sheet(path, "4", *TOP, ("Date", "PM10", "PM2.5", "SO2", "Time", "NO2"), ("",) * 6, ("1", "2", "3", "4", "5", "6"))
    skipped = sheet(path, "Summary", *TOP, HEAD) + sheet(path, "32", *TOP, HEAD)
    only_summary = sheet("/raw/Feb/2023/other.xlsx", "Notes", ("x",))
    return spark.createDataFrame(good + later + no_header + no_time + skipped + only_summary, CELLS)


def test_sheets_are_typed(spark):
    rows = sheets.load_sheets(cells(spark), root="/raw").orderBy("date_time").collect()
    assert [(r["date_time"], r["pm2_5"], r["pm10"], r["so2"], r["temp"]) for r in rows] == [
        (dt.datetime(2024, 1, 1, 12), 10.0, 20.0, None, 30.0), (dt.datetime(2024, 1, 1, 13), 11.0, None, 2.0, 31.0),
        (dt.datetime(2024, 1, 2, 0, 10), 5.0, 6.0, 7.0, 8.0)]
    first = rows[0]
    assert first["extra"] == {"pm10_2": 21.0, "dust_level": 7.0} and rows[1]["extra"] == {"pm10_2": 22.0, "dust_level": None}
    assert (first["station_name"], first["report_type"], first["time_base"], first["granularity"]) == ("North", "Daily", "15 Min", "quarter_hourly")
    assert (first["source_relative_path"], first["source_month_folder"], first["source_year"], first["source_sheet"]) == (
        "Jan/2023/AIIMS hourly.xlsx", "2023", 2023, "1")


def test_sheet_rejects_and_diagnostics(spark):
    heads = sheets.sheet_headers(cells(spark))
    reasons = {r["sheet"]: r["reason"] for r in sheets.rejected_sheets(heads).collect()}
    assert set(reasons) == {"3", "4"} and "header row" in reasons["3"] and "date_time" in reasons["4"]
    counts = {(r["section"], r["name"]): r["count"] for r in sheets.ingest_diagnostics(cells(spark), heads).collect()}
    assert counts[("files", "considered")] == 2 and counts[("files", "processed")] == 1
    assert counts[("skipped_files", "No daily numeric sheets found.")] == 1
    mapping = {r["raw_column_name"]: r["normalized_column_name"] for r in sheets.column_mapping(heads).collect()}
    assert mapping["PM10"] in ("pm10", "pm10_2") and mapping["Dust level"] == "dust_level"


def test_header_must_be_in_the_first_rows(spark):
    rows = sheet("/a/b.xlsx", "1", *[("x",)] * 20, HEAD, ("",) * 7, ("45292", "1", "2", "3", "4", "5", "6"))
    assert sheets.load_sheets(spark.createDataFrame(rows, CELLS)).count() == 0


def test_prepare_prefers_rows_with_more_readings(spark):
    fuller = sheet("/raw/Z/2023/z.xlsx", "1", *TOP, HEAD, ("",) * 7, ("01-01-2024 12:00", "99", "1", "2", "3", "4", "5"))
    out = flows.prepare(cells(spark).unionByName(spark.createDataFrame(fuller, CELLS)), root="/raw")
    noon = out.combined.where("hour = 12").first()
    assert noon["pm2_5"] == 99.0 and noon["source_row_count"] == 2 and noon["extra"]["dust_level"] == 5.0
    assert out.combined.count() == 3 and out.region_summary.first()["rows_after_merge"] == 3


def test_duplicate_files_with_a_hot_content(spark):
    paths = spark.range(3000).select(F.concat(F.lit("F/"), F.format_string("%05d", "id"), F.lit(".xlsx")).alias("path"),
                                     F.when(F.col("id") < 2000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("content"))
    upper = spark.createDataFrame([("f/00000.XLSX", "same"), ("A/own.xls", "own")], "path string, content string")
    everything = paths.unionByName(upper)
    kept = {r["kept_path"] for r in discovery.kept_files(everything).collect()}
    assert "F/00000.xlsx" in kept and "f/00000.XLSX" not in kept
    duplicates = discovery.duplicate_files(everything).collect()
    assert len(duplicates) == 2000 and {r["reason"] for r in duplicates} == {"Exact duplicate of F/00000.xlsx"}
    assert discovery.unique_files(everything).count() == 1002


def test_salted_lookup_equals_a_join(spark):
    rows = spark.range(5000).select((F.col("id") % 7 * (F.col("id") % 3 == 0).cast("int")).alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([(0, "hot"), (1, "one"), (3, "three"), (99, "none")], "k int, name string")
    want = sorted(map(tuple, rows.join(lookup, "k").collect()))
    for size in (1, 100, 10**6):
        assert sorted(map(tuple, salted_lookup(rows, lookup, ["k"], rows_per_task=size).select("k", "v", "name").collect())) == want


def test_archives(spark, tmp_path):
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("AIIMS/2023/a.xlsx", b"one")
        z.writestr("AIIMS/2023/~$a.xlsx", b"lock")
        z.writestr("../evil.xlsx", b"two")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s.zip").write_bytes(box.getvalue())
    (tmp_path / "in" / "readme.txt").write_text("no")
    safe, unsafe = files.split_unsafe(files.archive_members(files.archives(spark, str(tmp_path / "in"))))
    assert {r["member_path"] for r in safe.collect()} == {"AIIMS/2023/a.xlsx", "AIIMS/2023/~$a.xlsx"}
    assert [r["path"] for r in unsafe.collect()] == ["../evil.xlsx"]
    assert discovery.workbooks_only(safe, "member_path").count() == 1


def test_region_roots(spark, tmp_path):
    for name in ("SILTARA DCR", "other town", "late"):
        (tmp_path / name / "2023").mkdir(parents=True)
        (tmp_path / name / "2023" / "x.xls").write_bytes(name.encode())
        (tmp_path / name / "2023" / "~$x.xls").write_bytes(b"")
    found = files.region_files(spark, [str(tmp_path / "other town"), f"IGKV={tmp_path}/other town", str(tmp_path / "SILTARA DCR"),
                                       f"igkv={tmp_path}/late"])
    got = {r["region"]: r["path"].split("/")[-3].replace("%20", " ") for r in found.select("region", "path").collect()}
    assert got == {"OTHER_TOWN": "other town", "IGKV": "late", "SILTARA": "SILTARA DCR"}
    children = files.child_roots(spark, str(tmp_path))
    assert set(children) == {"OTHER_TOWN", "LATE", "SILTARA"} and children["LATE"].endswith("/late")
    with pytest.raises(ValueError, match="no station folders"):
        files.child_roots(spark, str(tmp_path / "late" / "2023"))
    assert files.parse_root_spec(' "C=/x" ')[0] == '"C' and files.parse_root_spec("/plain")[0] is None


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", T0, "hourly", 1.5, "n"), ("B", T0, "unknown", None, None)],
                               "region string, date_time timestamp_ntz, granularity string, pm2_5 double, station_name string")
    files.write_table(df, str(tmp_path / "p"), partition_by=["region", "granularity"])
    assert (tmp_path / "p" / "region=A" / "granularity=hourly").is_dir()
    back = spark.read.parquet(str(tmp_path / "p")).where("region = 'A'")
    assert "PartitionFilters: [isnotnull(region" in back._jdf.queryExecution().executedPlan().toString() and back.count() == 1
    files.write_table(df, str(tmp_path / "c"), fmt="csv")
    again = files.read_csv(spark, str(tmp_path / "c"), files.COMBINED_SCHEMA)
    assert dict(again.dtypes)["date_time"] == "timestamp_ntz" and again.where("region = 'A'").first()["pm2_5"] == 1.5
    assert files.read_csv(spark, str(tmp_path / "c"), files.COMBINED_SCHEMA, limit=1).count() == 1
    none = files.read_csv_or_empty(spark, str(tmp_path / "nothing"), files.COMBINED_SCHEMA)
    assert none.count() == 0 and none.schema == files.COMBINED_SCHEMA
    assert files.read_csv_or_empty(spark, str(tmp_path / "c"), files.COMBINED_SCHEMA).count() == 2


def test_constant_actuals_have_no_r2(spark):
    df = spark.createDataFrame([("A", T0, "test", "s", "t", 5.0, 4.0), ("A", T0, "test", "s", "t", 5.0, 6.0)],
                               "region string, date_time timestamp_ntz, split string, strategy string, target string, actual double, predicted double")
    row = evaluate.overall(evaluate.metrics_by_region(df)).first()
    assert row["r2"] is None and row["rmse"] == 1.0 and row["mae"] == 1.0


def test_winner_has_the_minimum_and_ties_go_by_name(spark):
    schema = "strategy string, split string, target string, region string, rmse double, mae double, r2 double, rows long, is_overall int"
    metrics = spark.createDataFrame([
        ("b", "validation", "t", "A", 1.0, 1.0, 0.0, 1, 0), ("a", "validation", "t", "A", 1.0, 1.0, 0.0, 1, 0),
        ("c", "validation", "t", "A", 0.9, 9.0, 0.0, 1, 0), ("a", "test", "t", "A", 0.1, 9.0, 0.0, 1, 0)], schema)
    assert evaluate.best_strategies(metrics).first()["strategy"] == "c"
    assert evaluate.best_strategies(metrics, "test").first()["strategy"] == "a"
    assert evaluate.best_strategies(metrics.where("strategy <> 'c'")).first()["strategy"] == "a"
    assert evaluate.best_strategies(metrics.limit(0)).count() == 0


def test_last_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, "A").otherwise("B").alias("region"), F.timestamp_add("HOUR", F.col("id"), F.lit(T0).cast("timestamp_ntz")).alias("date_time"))
    out = evaluate.last_rows(df, 5)
    assert out.count() == 10 and "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_json_of_forecasts(spark):
    df = spark.createDataFrame([("AIIMS", 95.0, 1.0, 1.0)], "region string, pm2_5 double, pm10 double, so2 double")
    out = flows.present_forecast(df, {t: F.col(t) for t in ("pm2_5", "pm10", "so2")})
    got = json.loads(flows.to_json(out).first()["json"])
    assert got["risk"]["category"] == "Severe" and got["anomaly_alerts"][0]["pollutant"] == "pm2_5"


def test_csv_columns_are_matched_by_each_files_header(spark, tmp_path):
    folder = tmp_path / "many files+1"
    folder.mkdir()
    (folder / "a.csv").write_text("region,pm2_5,pm10,odd metric\nA,1.0,2.0,7.5\n")
    (folder / "b.csv").write_text('\ufeffregion,"pm10",pm2_5\r\nB,20.0,10.0\r\n')
    got = {r["region"]: (r["pm2_5"], r["pm10"], r["extra"]) for r in files.read_csv(spark, str(folder), files.COMBINED_SCHEMA).collect()}
    assert got == {"A": (1.0, 2.0, {"odd metric": 7.5}), "B": (10.0, 20.0, {})}


def test_map_columns_become_csv_columns_and_come_back(spark, tmp_path):
    df = spark.createDataFrame([("A", T0, 1.0, {"radiation": 5.0, "pm2_5": 9.0}), ("B", T0, 2.0, {"noise": 3.0}), ("C", T0, 3.0, None)],
                               "region string, date_time timestamp_ntz, pm2_5 double, extra map<string,double>")
    files.write_table(df, str(tmp_path / "c"), fmt="csv", partition_by=["region"])
    back = files.read_csv(spark, str(tmp_path / "c"), files.COMBINED_SCHEMA)
    got = {r["region"]: (r["pm2_5"], r["extra"]) for r in back.collect()}
    assert got == {"A": (1.0, {"radiation": 5.0}), "B": (2.0, {"noise": 3.0}), "C": (3.0, {})}


def test_rows_without_a_date_are_reported(spark):
    header = ["Date & Time", "PM2.5", "PM10", "SO2", "NO2"]
    body = [["x"], [None], ["x"], ["x"], header, ["", "ug/m3"], ["01-Jan-2024 10:00", "1"], ["not a date", "2"], [None, "3"], [None, None]]
    cells = spark.createDataFrame([("AIIMS", "/a/2024/w.xlsx", "w.xlsx", "1", i, c) for i, c in enumerate(body)],
                                  "region string, path string, workbook string, sheet string, row_idx int, cells array<string>")
    assert sheets.load_sheets(cells).count() == 1
    assert sorted((r["row_idx"], r["date_cell"]) for r in sheets.undated_rows(cells).collect()) == [(7, "not a date"), (8, None)]
