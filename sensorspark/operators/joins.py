"""Joins that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def salted_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], sizes: DataFrame | None = None,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inner join of rows to a table with one row per key.

    Only keys with more than `rows_per_task` rows are split, into as many pieces
    as their size asks for; the lookup row of such a key is repeated once per
    piece. Adaptive skew handling does not act here, as the lookup is itself an
    aggregate. The list of split keys is broadcast: a table of N rows cannot
    have more than N / rows_per_task of them. `sizes` (keys and `rows`) saves
    the count where the caller already has it.
    """
    keys = list(keys)
    if sizes is None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    hot = F.broadcast(sizes.where(F.col("rows") > rows_per_task).select(
        *keys, F.ceil(F.col("rows") / rows_per_task).cast("int").alias("_pieces")))
    pieces = F.coalesce("_pieces", F.lit(1))
    payload = [F.col(f"`{c}`") for c in rows.columns if c not in keys]
    left = rows.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*payload), pieces.cast("bigint")).cast("int")).drop("_pieces")
    right = lookup.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces")
    return left.join(right, [*keys, "_salt"]).drop("_salt")
