import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorspark.llm import mixing


def copies(doc_id, rate, seed, text="t"):
    u = int(hashlib.md5(f"{seed}|{doc_id}|{text}".encode()).hexdigest()[:13], 16) / 2**52
    k, below = 0, math.exp(-rate)
    term = below
    while below <= u:
        k += 1
        term *= rate / k
        below += term
    return k


def test_copies_equal_brute_force_and_meet_the_weights(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 7 == 0, None)
                                  .otherwise("b").alias("source"), F.lit("t").alias("text"))
    weights = {"hot": 1.0, "b": 2.0, mixing.REST: 1.0, "absent": 9.0}
    sizes = Counter(r.source or mixing.REST for r in df.collect())
    out = mixing.mix(df, weights, total=8000, seed=4)
    got = Counter(r.doc_id for r in out.collect())
    for r in df.collect():
        b = r.source or mixing.REST
        assert got[r.doc_id] == copies(r.doc_id, 8000 * weights[b] / 4 / sizes[b], 4)
    shares = Counter(r.source or mixing.REST for r in out.collect())
    for b in sizes:
        want = 8000 * weights[b] / 4
        assert abs(shares[b] - want) < 5 * math.sqrt(want)


def test_order_is_global_and_does_not_follow_the_input(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "'a' as source")
    rows = mixing.mix(df, {"a": 1.0}, parts=7).withColumn("part", F.spark_partition_id()).collect()
    keys = [r.order_key for r in rows]
    assert keys == sorted(keys) and len({r.part for r in rows}) == 7
    again = mixing.mix(df.repartition(5), {"a": 1.0}, parts=3).collect()
    assert [(r.doc_id, r.copy) for r in again] == [(r.doc_id, r.copy) for r in rows]
    assert abs(sum(r.doc_id < 1500 for r in rows[: len(rows) // 2]) / len(rows) - 0.25) < 0.05


def test_large_rates_and_tables(spark):
    for rate in (0.0, 1e-6, 0.5, 40.0, 2000.0):
        table = mixing.poisson_table(rate)
        assert table[-1] == 1.0 and all(a <= b for a, b in zip(table, table[1:], strict=False))
        mean = sum(1 - c for c in table)
        assert mean == pytest.approx(rate, rel=1e-6, abs=1e-12)
    df = spark.range(3).selectExpr("id as doc_id", "'a' as source")
    assert abs(mixing.mix(df, {"a": 1.0}, total=3000).count() - 3000) < 300


@pytest.mark.parametrize("text", ["'the same'", "concat('text ', id)"])
def test_rows_without_id_are_drawn_each_by_itself(spark, text):
    df = spark.range(8000).selectExpr("cast(null as long) as doc_id", f"{text} as text", "'a' as source")
    out = mixing.mix(df, {"a": 1.0}, total=12000, parts=8).withColumn("part", F.spark_partition_id()).collect()
    assert abs(len(out) - 12000) < 5 * math.sqrt(12000)
    parts = Counter(r.part for r in out)
    assert len(parts) == 8 and all(abs(n - 1500) < 5 * math.sqrt(1500) for n in parts.values())


def test_one_id_with_many_texts(spark):
    df = spark.range(4000).selectExpr("7L as doc_id", "concat('text ', id) as text", "'a' as source")
    got = Counter(r.text for r in mixing.mix(df, {"a": 1.0}, total=6000, seed=3).collect())
    assert all(got[f"text {i}"] == copies(7, 1.5, 3, f"text {i}") for i in range(4000)) and len(set(got.values())) > 3


def test_rates_beyond_one_table(spark):
    df = spark.range(4).selectExpr("id as doc_id", "'t' as text", "'a' as source")
    out = Counter(r.doc_id for r in mixing.mix(df, {"a": 1.0}, total=400_000).groupBy("doc_id", "copy").count().filter("count = 1").collect())
    assert all(abs(n - 100_000) < 6 * math.sqrt(100_000) for n in out.values()) and len(set(out.values())) == 4
    assert len(mixing.poisson_table(mixing.MOST)) < 200


def test_awkward_rows(spark, odd_docs, no_docs):
    out = mixing.mix(odd_docs.withColumn("copy", F.lit("x")), {"src0": 1.0, mixing.REST: 1.0}, total=400)
    assert out.columns == [*odd_docs.columns, "copy", "order_key"] and 200 < out.count() < 600
    assert {r.source for r in out.collect()} == {None, "src0", "src1"}
    only = mixing.mix(odd_docs, {"src0": 1.0}).collect()
    assert only and {r.source for r in only} == {"src0"}
    assert mixing.mix(no_docs, {"src0": 1.0}).count() == 0 and mixing.mix(odd_docs, {"none": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.rates(odd_docs, {"a": -1.0})
