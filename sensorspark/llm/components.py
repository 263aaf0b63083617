"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.plans.shared import materialize

SALTS = 16


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """Rows of (a, b) with the least node around a; the rows of a node with very many links are dealt over SALTS keys."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    every = least.select("a", "m", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    return salted.join(every, ["a", "salt"]).select("a", "b", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _with_least(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(down, least).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of `edges` (a, b) and the least node it is connected to.

    Large and small stars alternate until nothing moves, a number of rounds that grows with the
    logarithm of a component's size. Each round is a table in the shared folder, so a lost
    executor costs at most the round at hand. Links from a node to itself and repeated links
    do no harm; an empty table gives an empty one. The links of one node are spread over SALTS tasks.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), "links")
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
        edges = materialize(_small_star(_large_star(edges)), "links")
