"""Mixing sources to target weights by Poisson replication.

A bucket (a source with a weight of its own; all others together) of n documents and target
share w gets total * w documents on average, so each of its documents is repeated with mean
rate total * w / n. The number of copies is the inverse of the Poisson distribution at a number
hashed from seed, id and text, so a rerun, or any partitioning, gives the same mix. A rate beyond
MOST is split into equal parts, whose copies add up, so tables stay short whatever the rate. Copies
are exploded, in blocks, and dealt out over the cluster by a second hash, which is their place in the
global order: every output partition is one slice of that order, itself in order.

Built-in expressions only. The corpus is counted by bucket; that table has at most one row per
given weight and one more, each with a table of at most some 150 numbers in the plan. Nothing depends
on how many rows a source has: no step groups or partitions documents by source.

Edge cases: a missing source belongs to the rest; missing texts count as empty ones. Rows of one id with different texts
are drawn each by itself; rows equal in id and text get equal numbers of copies. A row without id is drawn by its
place in the table, so the same files give the same mix, but another partitioning may give these rows other numbers. Buckets without documents
get no share: the shares of the others grow in proportion. A weight of zero removes a source.
Columns named like the results are replaced; all others are carried unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import unit_hash

REST = "*"
RESULTS = ("copy", "order_key")
# Largest rate that is inverted in one piece, and copies that are exploded at once.
MOST, BLOCK = 64.0, 4096
_TAIL = 1e-18


def poisson_table(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until the rest is below what a 52-bit number can tell."""
    if rate <= 0:
        return [1.0]
    table, total, k = [], 0.0, 0
    while True:
        term = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        total += term
        table.append(min(total, 1.0))
        if k > rate and term < _TAIL:
            return [*table[:-1], 1.0]
        k += 1


def bucket_of(source: Column, weights: Mapping[str, float]) -> Column:
    named = [s for s in weights if s != REST]
    return F.when(source.isin(named), source).otherwise(F.lit(REST)) if named else F.lit(REST)


def rates(df: DataFrame, weights: Mapping[str, float], total: int | None = None, source: str = "source") -> dict[str, float]:
    """Mean copies per document of each bucket that has documents; `total` None keeps the corpus size."""
    if any(w < 0 or not math.isfinite(w) for w in weights.values()):
        raise ValueError("weights must be finite and not negative")
    counted = df.groupBy(bucket_of(F.col(f"`{source}`"), weights).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["b"]: r["n"] for r in counted}  # at most one row per weight and one more
    wanted = {b: float(weights.get(b, 0.0)) for b in sizes}
    share, size = sum(wanted.values()), sum(sizes.values()) if total is None else total
    return {b: size * wanted[b] / share / sizes[b] if share else 0.0 for b in sizes}


def _copies(rate: float, seed: int) -> Column:
    """Copies of a row with key and text `_said`: a Poisson number of mean `rate`."""
    pieces = max(1, math.ceil(rate / MOST))
    table = F.array(*[F.lit(p) for p in poisson_table(rate / pieces)])
    inverse = lambda u: F.size(F.filter(table, lambda p: p <= u))
    if pieces == 1:
        return inverse(unit_hash(F.lit(seed), "_said"))
    numbers = F.sequence(F.lit(1), F.lit(pieces))
    return F.aggregate(numbers, F.lit(0), lambda n, i: n + inverse(unit_hash(F.lit(seed), "_said", i)))


def mix(df: DataFrame, weights: Mapping[str, float], total: int | None = None, seed: int = 17, source: str = "source",
        doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """The columns of the input, `copy` (from 0) and `order_key`: one row per copy, globally shuffled.

    `weights` maps sources to target shares; the key "*" stands for all sources not named.
    """
    spark = df.sparkSession
    found = rates(df, weights, total, source)
    carried = [F.col(f"`{c}`") for c in df.columns if c not in RESULTS]
    bucket = bucket_of(F.col(f"`{source}`"), weights)
    row = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), row)
    content = F.coalesce(F.col(f"`{text}`"), F.lit("")) if text in df.columns else F.lit("")
    keyed = df.select(*carried, key.alias("_key"), F.concat_ws("|", key, content).alias("_said"), bucket.alias("_bucket"))
    copies = F.lit(0)
    for name, rate in sorted(found.items()):
        copies = F.when(F.col("_bucket") == name, _copies(rate, seed)).otherwise(copies)
    named = keyed.withColumn("copy", copies).filter("copy > 0")
    # Two steps, so that no array is longer than a block or the number of blocks.
    starts = named.withColumn("_from", F.explode(F.sequence(F.lit(0), F.greatest(F.col("copy") - 1, F.lit(0)), F.lit(BLOCK))))
    each = starts.withColumn("copy", F.explode(F.sequence("_from", F.least(F.col("_from") + (BLOCK - 1), F.col("copy") - 1))))
    order = unit_hash(F.lit(seed + 1), "_said", "copy")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = each.withColumn("order_key", order).select(*carried, "copy", "order_key").repartitionById(parts, F.floor(F.col("order_key") * parts).cast("int"))
    return dealt.sortWithinPartitions("order_key")
