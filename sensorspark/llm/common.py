"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds over 1/HOT_SHARE of the rows, so at most HOT_SHARE - 1 keys can be hot.
HOT_SHARE = 64


def documents(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The two columns every document operator reads; a missing text is an empty one."""
    return df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def spread_lookup(rows: DataFrame, mapping: DataFrame, key: str, counts: DataFrame, total: int) -> DataFrame:
    """Left join of `rows` with `mapping` on `key`, where one key may hold a large share of the rows.

    `counts` has (key, n) for every key. The fewer than HOT_SHARE hot keys are joined by
    broadcast, which leaves their rows where they are; all others go through a plain shuffle.
    """
    hot = F.broadcast(counts.filter(F.col("n") * HOT_SHARE > total).select(key))
    hot_rows = rows.join(hot, key, "left_semi")
    hot_mapping = F.broadcast(mapping.join(hot, key, "left_semi"))
    return hot_rows.join(hot_mapping, key, "left").unionByName(
        rows.join(hot, key, "left_anti").join(mapping, key, "left"))


def unit_hash(*parts: Column | str) -> Column:
    """Reproducible number in [0, 1) from the first 52 bits of an MD5 over the parts, joined by a bar."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit(""))
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def finite_vectors(df: DataFrame, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """(id, vector) as doubles of the rows whose vector is there, not empty and all finite."""
    value = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return df.select(F.col(f"`{id}`").alias("id"), value.alias("vector")).filter((F.size(value) > 0) & finite)
