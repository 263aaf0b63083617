import random
import re

import xxhash
from pyspark.sql import functions as F

from sensorspark.llm import simhash as s
from sensorspark.llm.components import components


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points):
    parent = {n: n for _, n in points}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, (f, n) in enumerate(points):
        for g, m in points[:i]:
            if (f ^ g).bit_count() <= 2:
                a, b = sorted((root(n), root(m)))
                parent[b] = a
    return {n: root(n) for _, n in points}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_equal_brute_force_and_spark_hash(spark, odd_docs):
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect() if r.doc_id is not None}
    for r in s.fingerprints(odd_docs).collect():
        if r.doc_id is not None:
            assert r.fp == signed(brute_fingerprint(texts[r.doc_id])), r.doc_id
    assert spark.range(1).select(F.xxhash64(F.lit("é one"))).first()[0] == signed(xxhash.xxh64_intdigest("é one".encode(), 42))


def test_manhattan_bound(spark):
    random.seed(3)
    pairs = []
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for _ in range(random.randint(0, 5)):
            b ^= 1 << random.randrange(64)
        pairs.append((signed(a), signed(b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    d = lambda x, y: F.bit_count(x.bitwiseXOR(y))
    rows = df.select("a", "b", d(F.col("a"), F.col("b")).alias("h"), d(s.embedding(F.col("a")), s.embedding(F.col("b"))).alias("m")).collect()
    for r in rows:
        counts = [[(x >> 2 * i & 3).bit_count() for i in range(32)] for x in (r.a % (1 << 64), r.b % (1 << 64))]
        assert r.m == sum(abs(p - q) for p, q in zip(*counts, strict=True)) <= r.h


def test_links_with_and_without_crowded_cells(spark):
    random.seed(5)
    seen = set()
    for _ in range(6):
        centre = random.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(random.randint(0, 6)):
                x ^= 1 << random.randrange(64)
            seen.add(x)
    points = [(signed(x), i) for i, x in enumerate(sorted(seen))]
    random.shuffle(points)
    want = brute_components([(f % (1 << 64), n) for f, n in points])
    df = spark.createDataFrame(points, "fp long, node long")
    for limit in (2, 8, 1000):
        found = {r.node: r.component for r in components(s.links(df, cell_limit=limit)).collect()}
        assert {n: found.get(n, n) for n in want} == want, limit


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(7, 7), (3, 4)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(201)) and all(found[1000 + i] == 1000 for i in range(100))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_table(spark, folder):
    from sensorspark.llm.queries import QUERIES

    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs}
    want = brute_components([(f, n) for n, f in prints.items()])
    rows = QUERIES["op2_simhash_dedup"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]


def test_hot_fingerprint_and_one_of_each_group(spark, odd_docs, no_docs):
    same = spark.range(500).select((F.col("id") + 10).alias("doc_id"), F.lit("the very same text in all of these").alias("text"))
    rows = s.classes(same).collect()
    assert len(rows) == 500 and {r.component_id for r in rows} == {10}
    assert [r.doc_id for r in s.keep_one(same.union(same)).collect()] == [10]
    kept = s.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and s.classes(odd_docs).count() == odd_docs.count()
    ids = [r.doc_id for r in kept.collect()]
    assert 5 in ids and 6 not in ids and ids.count(5) == 1 and ids.count(None) == 0 and 0 in ids and 1 not in ids
    assert s.classes(no_docs).count() == 0 and s.keep_one(no_docs).count() == 0


def test_one_id_with_two_texts_and_copies_without_id(spark):
    one, two = "some words that stand in the first of these texts", "quite another sentence which shares nothing at all with it"
    df = spark.createDataFrame([(1, one), (1, two), (2, one), (None, one), (None, "a text that only a row without id has, twice"),
                                (None, "a text that only a row without id has, twice")], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in s.keep_one(df).collect())
    assert kept == sorted([(1, one), (1, two), (0, "a text that only a row without id has, twice")])
    found = {(r.doc_id, r.component_id) for r in s.classes(df).collect()}
    assert found == {(1, 1), (2, 1), (None, 1), (None, None)}


def test_hub_of_most_links_stays_spread(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert all(found[i] == 0 for i in range(3000)) and all(found[i] == 5000 for i in range(5000, 5101))
