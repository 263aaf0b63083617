"""Work per task stays bounded as tables grow."""

from sensorspark.operators import models
from sensorspark.plans import flows
from sensorspark.sources import sheets
from sensorspark.streaming import jobs
from test_models import run, series  # noqa: F401

CELLS = "region string, path string, workbook string, sheet string, row_idx int, cells array<string>"


def sheet_rows(n):
    names = ["Date & Time", "PM2.5", "PM10", "SO2", "WS", "WD"]
    for i in range(n):
        key = ("A", f"/raw/2024/A/u{i // 31}.xlsx", f"u{i // 31}.xlsx", str(i % 31 + 1))
        yield (*key, 0, ["Station", f"S{i}"])
        yield (*key, 3, ["Time Base", None])
        yield (*key, 5, names if i % 3 else ["no header here"])
        if i % 2:  # two header rows: the first counts
            yield (*key, 7, names[::-1])
        yield (*key, 9, ["01-01-2024 10:00", "1", "2", "3", "4", "5"])


def test_header_rows_are_dealt_to_tasks_before_they_are_sorted(spark, monkeypatch):
    cells = spark.createDataFrame(list(sheet_rows(300)), CELLS).coalesce(1)
    monkeypatch.setattr(sheets, "ROWS_PER_TASK", 100)
    heads = sheets.sheet_headers(cells)
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan[plan.index("Exchange"):]
    assert heads.rdd.getNumPartitions() == 14  # 1,350 rows, 100 a task
    got = {(r["path"], r["sheet"]): r for r in heads.collect()}
    assert len(got) == 300
    for i in range(300):
        r = got[f"/raw/2024/A/u{i // 31}.xlsx", str(i % 31 + 1)]
        assert (r["station_name"], r["time_base"], r["report_type"]) == (f"S{i}", None, None)
        assert r["header_row"] == (5 if i % 3 else 7 if i % 2 else None)
        assert r["names"] is None if r["header_row"] is None else r["names"][0] == ("date_time" if r["header_row"] == 5 else "wd")


def test_tasks_of_header_rows_do_not_bind_the_data_rows(spark):
    cells = spark.createDataFrame(list(sheet_rows(300)), CELLS)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sheets.load_sheets(cells)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    dealt = [x for x in plan[plan.index("SortMergeJoin"):].splitlines() if "Exchange hashpartitioning" in x]
    assert len(dealt) == 2 and all(", 8), " in x for x in dealt)  # both sides of the join; the header rows go to one task
    assert sheets.load_sheets(cells).count() == 250  # one row each of the sheets with a header; 50 have none


def test_stream_scoring_is_dealt_over_tasks(spark, run, monkeypatch, tmp_path):
    """A micro-batch from one file is scored by several tasks, with the forecasts of one."""
    rows = [(i, ["AIIMS", "SILTARA", "nowhere"][i % 3], f"2024-01-1{i % 9}T10:00:00", 40.0 + i, 90.0, 12.0) for i in range(36)]
    batch = spark.createDataFrame(rows, "event_id long, region string, timestamp string, pm25 double, pm10 double, so2 double").coalesce(1)
    told = lambda df: sorted(map(str, df.select("event_id", "pm2_5_forecast", "pm10_forecast", "so2_forecast", "pm2_5_strategy").collect()))
    want = told(flows.score(run.bundle, batch, "best", ("event_id",)))
    seen = []
    monkeypatch.setattr(models, "SCORED_PER_TASK", 4)
    monkeypatch.setattr(jobs, "score", lambda bundle, df, *a: seen.append(df.rdd.getNumPartitions()) or flows.score(bundle, df, *a))
    job = jobs.ModelScoringJob(spark, str(tmp_path), run.bundle, "best", keep=["event_id"])
    job.process(batch, 0)
    assert seen == [9] and told(job.scores()) == want and len(want) == 24  # one station is unknown
