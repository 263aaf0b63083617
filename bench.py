"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated keys, default: the headline list).
BENCH_DUCKDB=1 also times the SQL twin of each query in DuckDB.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries import ORACLES, QUERIES  # noqa: E402
from sensorspark.session import build_session  # noqa: E402

HEADLINE = (
    "rolling_zscore_alerts", "align_granularity", "best_row_per_timestamp", "duplicate_summary", "merge_with_lineage",
    "combine_regions_union", "parse_dirty_dates", "normalize_headers", "content_dedupe", "load_sheet_cells",
    "prepare_flow", "reading_bounds_rejects", "regular_grid", "station_fill", "calendar_cyclic", "lag_features",
    "rolling_features", "group_lag", "chronological_split", "quantile_clip", "column_quantiles", "median_impute",
    "metrics_grouping_sets", "leaderboard", "best_strategy_table", "risk_4_level", "rule_forecast", "spike_alerts",
    "combined_alert_review", "forecast_report_text", "model_frame", "rf_forecast", "stream_risk_scoring", "stream_zscore",
)


def duckdb_seconds(folder: str, cpus: str, names: list[str]) -> dict[str, float]:
    import duckdb

    con = duckdb.connect(config={"threads": int(cpus)})
    for file in os.listdir(folder):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{folder}/{file}'")
    out = {}
    for name in names:
        if name in ORACLES:
            start = time.perf_counter()
            con.sql(ORACLES[name]).fetchall()
            out[name] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # The noop sink computes every output row and column without moving them to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}
    if os.environ.get("BENCH_DUCKDB"):
        result["duckdb"] = duckdb_seconds(folder, cpus, names)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
