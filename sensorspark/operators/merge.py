"""One row per (region, granularity, timestamp) out of overlapping source rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import non_null_score
from sensorspark.functions.text import clean_text
from sensorspark.functions.times import align_to_granularity, calendar_parts

KEYS = ("region", "granularity", "date_time")
_NOT_METRICS = {*KEYS, *K.LINEAGE_COLUMNS, *K.DESCRIPTION_COLUMNS}


def metric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Sensor and extra metric columns: everything that is neither key, lineage nor description."""
    return sorted(c for c in df.columns if c not in _NOT_METRICS and c not in exclude)


def align_rows(df: DataFrame) -> DataFrame:
    """Round timestamps to the row's granularity and drop rows without a timestamp."""
    return df.where(F.col("date_time").isNotNull()).withColumn(
        "date_time", align_to_granularity(F.col("date_time"), F.col("granularity")))


def _quality(score: Column) -> Column:
    """Sort position of a row: most readings first, then path, then sheet."""
    return F.struct(
        (-score).alias("_worse"),
        F.col("source_relative_path").alias("_path"),
        F.col("source_sheet").alias("_sheet"),
    )


def best_row_per_key(df: DataFrame, keys: Sequence[str] = KEYS, metrics: Sequence[str] | None = None) -> DataFrame:
    """Row with the most readings per key; ties by path, sheet, then the row's own values.

    MIN over a struct collapses rows on the map side, so a key that holds a
    large share of the table costs no more than any other.
    """
    metrics = metric_columns(df) if metrics is None else list(metrics)
    rest = [c for c in df.columns if c not in keys]
    score = non_null_score(*[F.col(c) for c in metrics])
    row = F.struct(_quality(score).alias("_quality"), *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(row).alias("_best"))
    return best.select(
        *keys, *[F.col("_best")[c].alias(c) for c in rest],
        (-F.col("_best")["_quality"]["_worse"]).alias("selected_row_non_null_score"),
    )


def _joined(items: Column, field: str) -> Column:
    """Distinct values of one lineage column in first-seen order, joined with ` | `."""
    texts = F.filter(F.transform(items, lambda x: clean_text(x[field])), lambda t: t.isNotNull())
    return F.nullif(F.array_join(F.array_distinct(texts), " | "), F.lit(""))


def merge_duplicates(df: DataFrame, keys: Sequence[str] = KEYS, metrics: Sequence[str] | None = None,
                     score: Column | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Best row per key together with the lineage of all rows of the key.

    `score` replaces the plain number of non-null metrics; `ties` order rows that
    agree in score, path and sheet.

    Two aggregations instead of a ranking window and a join: rows of the same
    (key, lineage) collapse first, which is salted by the lineage itself, then
    the few distinct lineages of a key are put in order.
    """
    metrics = metric_columns(df) if metrics is None else list(metrics)
    payload = [*metrics, *[c for c in K.DESCRIPTION_COLUMNS if c in df.columns]]
    if score is None:
        score = non_null_score(*[F.col(c) for c in metrics])
    return _merged(df, keys, payload, score, ties)


def _merged(df: DataFrame, keys: Sequence[str], payload: Sequence[str], score: Column,
            ties: Sequence[str] = ()) -> DataFrame:
    lineage = [c for c in K.LINEAGE_COLUMNS if c in df.columns]
    row = F.struct(_quality(score).alias("_quality"), *[F.col(c) for c in dict.fromkeys([*ties, *payload])])
    per_source = df.groupBy(*keys, *lineage).agg(
        F.min(row).alias("_best"), F.count(F.lit(1)).alias("_rows"))
    source = F.struct(F.col("_best")["_quality"].alias("_quality"), *[F.col(c) for c in lineage])
    merged = per_source.groupBy(*keys).agg(
        F.min("_best").alias("_best"),
        F.sum("_rows").alias("source_row_count"),
        F.array_sort(F.collect_list(source)).alias("_sources"),
    )
    out = {
        "source_row_count": F.col("source_row_count"),
        "source_file_count": F.size(F.array_distinct(F.filter(
            F.transform("_sources", lambda s: s["source_relative_path"]), lambda p: p.isNotNull()))).cast("bigint"),
        "selected_row_non_null_score": -F.col("_best")["_quality"]["_worse"],
    }
    for name in K.LINEAGE_COLUMNS:
        if name not in lineage:
            continue
        if name == "source_year":
            years = F.filter(F.transform("_sources", lambda s: s["source_year"]), lambda y: y.isNotNull())
            out[name] = F.get(years, F.lit(0))
        else:
            out[name] = _joined(F.col("_sources"), name)
    parts = calendar_parts(F.col("date_time")) if "date_time" in keys else {}
    front = [k for k in ("region", "date_time", "granularity") if k in keys]
    front += [k for k in keys if k not in front]
    return merged.select(
        *front, *[c.alias(n) for n, c in parts.items()],
        *[F.col("_best")[c].alias(c) for c in payload],
        *[c.alias(n) for n, c in out.items()],
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str] = KEYS, metrics: Sequence[str] | None = None) -> DataFrame:
    """Row count, file count and joined lineage per key."""
    metrics = metric_columns(df) if metrics is None else list(metrics)
    merged = _merged(df, keys, (), non_null_score(*[F.col(c) for c in metrics]))
    lineage = [c for c in K.LINEAGE_COLUMNS if c in df.columns]
    return merged.select(*keys, "source_row_count", "source_file_count", *lineage)


def merge_report(merged: DataFrame, by: str = "region") -> DataFrame:
    """Rows, duplicated timestamps and rows per granularity of each region's merged table."""
    per_kind = merged.groupBy(by, "granularity").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("source_row_count") > 1).alias("_groups"),
        F.max("source_row_count").alias("_most"),
    )
    return per_kind.groupBy(by).agg(
        F.sum("_rows").alias("rows_after_merge"),
        F.sum("_groups").alias("duplicate_timestamp_groups"),
        F.max("_most").alias("max_rows_combined_per_timestamp"),
        F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.coalesce("granularity", F.lit("null")), "_rows")))).alias("granularity_counts"),
    )


def combine_regions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Union of the regions' tables by column name, with the region as first column."""
    out = None
    for region, table in tables.items():
        part = align_rows(table).withColumn("region", F.lit(region))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no region tables to combine")
    return out.select("region", *[c for c in out.columns if c != "region"])


def sort_combined(df: DataFrame) -> DataFrame:
    return df.orderBy("region", "date_time", "granularity")


def region_summary(combined: DataFrame) -> DataFrame:
    kinds = {f"{g}_rows": F.count_if(F.col("granularity") == g)
             for g in ("hourly", "quarter_hourly", "unknown")}
    return combined.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows_after_merge"), *[c.alias(n) for n, c in kinds.items()])


def region_coverage(df: DataFrame, targets: Sequence[str] = K.TARGETS) -> DataFrame:
    return df.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date_time").alias("start_time"),
        F.max("date_time").alias("end_time"),
        *[F.count(t).alias(f"{t}_non_null") for t in targets],
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value; NULL is a value too."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
