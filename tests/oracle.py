"""Compare a Spark query with its SQL twin in DuckDB."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else float(f"{value:.9g}")
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    relation = con.sql(sql)
    want_columns, want = relation.columns, relation.fetchall()
    got_columns, got = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    if sorted(want_columns) != sorted(got_columns):
        return False, f"columns differ: spark {sorted(got_columns)} sql {sorted(want_columns)}"
    if len(want) != len(got):
        return False, f"rows differ: spark {len(got)} sql {len(want)}"
    left, right = rows_of(got_columns, got), rows_of(want_columns, want)
    if left != right:
        return False, (f"{sum((left - right).values())} of {len(got)} rows differ in {sorted(got_columns)}: "
                       f"spark {list((left - right).items())[:2]} sql {list((right - left).items())[:2]}")
    return True, f"{len(got)} rows"
