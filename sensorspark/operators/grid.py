"""Regular time grid per region and gap filling of station names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark import constants as K
from sensorspark.functions.times import from_micros, micros, seconds
from sensorspark.operators.series import ROWS_PER_CHUNK


def keep_last(df: DataFrame, keys: Sequence[str] = ("region", "date_time"), order: Sequence[str] = ()) -> DataFrame:
    """Last row per key by `order`, then by the remaining columns that have an order (maps have none).

    An aggregate, not a ranking window: copies collapse on the map side, so a
    key with very many rows never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    maps = {f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)}
    ranked = [*order, *[c for c in rest if c not in order and c not in maps]]
    # A map travels as its entries, sorted, so that ties of all other columns still have one winner.
    place = [F.col(c) for c in ranked] + [F.array_sort(F.map_entries(c)) for c in rest if c in maps]
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*place)).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def grid_spine(df: DataFrame, step: int, region: str = "region", ts: str = "date_time",
               block: int = ROWS_PER_CHUNK) -> DataFrame:
    """Every step from the first to the last timestamp of each region.

    Blocks of steps are spread over the cluster before they are expanded, so
    one long series is not generated by one task.
    """
    step_us = F.lit(step * 1_000_000)
    ends = df.where(F.col(region).isNotNull() & F.col(ts).isNotNull()).groupBy(region).agg(
        micros(F.min(ts)).alias("_from"), micros(F.max(ts)).alias("_to"))
    blocks = ends.select(
        region, "_from", F.floor((F.col("_to") - F.col("_from")) / step_us).cast("bigint").alias("_last"),
    ).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last") / block).cast("bigint"))).alias("_block"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("_block") * block
    return (
        blocks.repartition(partitions, region, "_block")
        .select(region, "_from", F.explode(F.sequence(first, F.least(first + (block - 1), F.col("_last")))).alias("_i"))
        .select(region, from_micros(F.col("_from") + F.col("_i") * step_us).alias(ts))
    )


def regular_grid(df: DataFrame, granularity: str, region: str = "region", ts: str = "date_time",
                 order: Sequence[str] = (), fill: Sequence[str] = ("station_name",),
                 block: int = ROWS_PER_CHUNK) -> DataFrame:
    """Readings on a regular grid; gaps become rows of NULLs with observed_row = 0.

    Readings off the grid are dropped, the last reading of a timestamp is kept
    and `fill` columns are filled forward, then backward.
    """
    step = K.STEP_SECONDS[granularity]
    readings = keep_last(df, (region, ts), order).withColumn("_seen", F.lit(1))
    if "granularity" in df.columns:
        readings = readings.withColumn("_seen", F.col("granularity").isNotNull().cast("int"))
    spine = grid_spine(df, step, region, ts, block)
    joined = spine.join(readings, [region, ts], "left")
    out = joined.withColumns({
        "observed_row": F.coalesce(F.col("_seen"), F.lit(0)),
        "granularity": F.lit(granularity),
    }).drop("_seen")
    for column in fill:
        if column in df.columns:
            out = fill_series(out, column, step, region, ts)
    rest = [c for c in df.columns if c not in (region, ts, "granularity")]
    return out.select(region, ts, "granularity", *rest, "observed_row")


def fill_series(df: DataFrame, column: str, step: int, region: str = "region", ts: str = "date_time",
                rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Forward then backward fill per region, chunk by chunk.

    Inside a chunk a window fills; what crosses a chunk border comes from a
    table with the first and last known value of each chunk.
    """
    width = F.lit(step * rows_per_chunk)
    marked = df.withColumn("_chunk", F.floor(seconds(F.col(ts)) / width).cast("bigint"))
    line = Window.partitionBy(region, "_chunk").orderBy(ts)
    inner = marked.withColumns({
        "_before": F.last(column, True).over(line.rowsBetween(Window.unboundedPreceding, 0)),
        "_after": F.first(column, True).over(line.rowsBetween(0, Window.unboundedFollowing)),
    })
    known = marked.where(F.col(column).isNotNull()).groupBy(region, "_chunk").agg(
        F.max_by(column, ts).alias("_last"), F.min_by(column, ts).alias("_first"))
    every = marked.select(region, "_chunk").distinct().join(known, [region, "_chunk"], "left")
    # One row per region and chunk.
    chunks = Window.partitionBy(region).orderBy("_chunk")
    carried = every.select(
        region, "_chunk",
        F.last("_last", True).over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
        F.first("_first", True).over(chunks.rowsBetween(1, Window.unboundedFollowing)).alias("_coming"),
    )
    filled = F.coalesce("_before", "_carry", "_after", "_coming")
    return (
        inner.join(carried, [region, "_chunk"], "left")
        .withColumn(column, filled)
        .select(*df.columns)
    )
