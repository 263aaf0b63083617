import math
import random
import re
from collections import Counter

import numpy as np

from sensorspark.llm import search


def brute(docs, queries, k):
    cut = lambda x: [w for w in re.split(r"[^\w]+|_", (x or "").lower()) if w]
    docs = [(i, Counter(cut(t))) for i, t in docs if i is not None]
    n, mean = len(docs), sum(sum(c.values()) for _, c in docs) / max(len(docs), 1)
    df = Counter(w for _, c in docs for w in c)
    out = {}
    for q, text in queries:
        asked = Counter(cut(text))
        scored = []
        for i, c in docs:
            dl = sum(c.values())
            s = sum(round(f * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * (
                c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * dl / mean))) * 2**30) for w, f in asked.items() if w in c)
            if s:
                scored.append((-s / 2**30, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def check(spark, docs, queries, k, shard_chars):
    schema = "doc_id long, text string"
    found = search.top_k(spark.createDataFrame(docs, schema), spark.createDataFrame(queries, schema), k, shard_chars=shard_chars)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    want = {q: rows for q, rows in brute(docs, queries, k).items() if rows}
    assert got.keys() == want.keys()
    for q, rows in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows], q
        assert all(abs(a - b) < 1e-6 for (_, a), (_, b) in zip(got[q], rows, strict=True))


def test_equals_brute_force_over_any_shards(spark):
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(60000)]
    docs = [(i, " ".join(words[a: a + rng.randint(1, 120)])) for i in range(1500) for a in [rng.randrange(len(words) - 120)]]
    docs += [(2000 + i, docs[i % 7][1]) for i in range(60)]  # groups of equal texts: ties go to the lower id
    queries = [docs[i] for i in range(0, 1500, 75)] + [(9999, "w1 w2 absent"), (9998, "absent only")]
    for shard_chars in (10**9, 60_000):
        check(spark, docs, queries, 10, shard_chars)


def test_pruning_skips_lists_and_stays_exact():
    rng = random.Random(4)
    texts = [" ".join(["common"] * rng.randint(1, 4) + [f"r{rng.randrange(400)}" for _ in range(30)]) for _ in range(5000)]
    shard = search.Shard(list(range(5000)), texts, 33.0)
    touched = []
    whole = shard._lists
    shard._lists = lambda starts, lo: touched.append((starts is shard.start, len(lo))) or whole(starts, lo)
    terms = sorted(set(texts[17].split()))
    weights = [0.05 if t == "common" else 5.0 for t in terms]
    ids, scores = shard.search(terms, weights, 3)
    assert sum(n for own, n in touched if own) < len(terms)
    exact = {}
    for t, w in zip(terms, weights, strict=True):
        a, b = shard.start[shard.vocabulary[t]], shard.start[shard.vocabulary[t] + 1]
        for d, x in zip(shard.doc[a:b], shard.impact[a:b], strict=True):
            exact[int(d)] = exact.get(int(d), 0) + round(w * x * 2**30)
    want = sorted(exact.items(), key=lambda e: (-e[1], e[0]))[:3]
    assert [(int(i), round(s * 2**30)) for i, s in zip(ids, scores, strict=True)] == want


def test_many_queries_at_once_skip_blocks_and_documents():
    """Only words of queries are indexed; few documents are scored in full, with and without blocks that stand out."""
    rng = random.Random(12)
    texts = [" ".join(rng.choices([f"f{i}" for i in range(40)], k=60) + rng.choices([f"r{i}" for i in range(3000)], k=20)) for _ in range(3000)]
    texts[700:720] = [texts[700] + f" more{i}" for i in range(20)]  # near copies: a high threshold
    vocabulary = {w: 3 * i for i, w in enumerate(sorted({w for q in range(0, 3000, 100) for w in texts[q].split()}))}
    shard = search.Shard.empty(vocabulary, 3 * len(vocabulary))
    for i, text in enumerate(texts):
        shard.add(i, text)
    shard.finish(80.0)
    assert set(shard.term.tolist()) <= set(vocabulary.values()) and shard.columns.shape[1] >= 40
    queries = []
    for q in range(0, 3000, 100):
        counts = Counter(texts[q].split())
        queries.append((np.array([vocabulary[w] for w in counts]), np.array([c * (0.5 if w[0] == "f" else 4.0) for w, c in counts.items()])))
    found = shard.search_many(queries, 5)
    assert shard.scored < len(queries) * shard.n / 16
    lists = [range(shard.start[t], shard.start[t + 1]) for t in range(shard.size)]
    for (t, w), (ids, scores) in zip(queries, found, strict=True):
        exact = Counter()
        for a, b in zip(t, w, strict=True):
            for at in lists[a]:
                exact[int(shard.doc[at])] += round(b * shard.impact[at] * 2**30)
        want = sorted(exact.items(), key=lambda e: (-e[1], e[0]))[:5]
        assert [(int(i), round(s * 2**30)) for i, s in zip(ids, scores, strict=True)] == want
    one = shard.search_many(queries[:1], 5)[0]
    assert one[0].tolist() == found[0][0].tolist() and one[1].tolist() == found[0][1].tolist()


def test_copies_of_queries_carry_numbers(spark):
    docs = spark.createDataFrame([(1, "a b b c"), (2, "b d"), (3, "")], "id long, text string")
    lists, asked = search.query_words(docs.filter("id < 3"), docs, 3, 2)
    number = {w: p * 2 + r.chunk for r in lists.collect() for p, w in enumerate(r.words)}
    assert sorted(number) == ["a", "b", "c", "d"] and len(set(number.values())) == 4
    assert dict(asked.dtypes) == {"id": "bigint", "terms": "array<int>", "counts": "array<int>"}
    got = {r.id: dict(zip(r.terms, r.counts, strict=True)) for r in asked.collect()}
    assert got == {1: {number["a"]: 1, number["b"]: 2, number["c"]: 1}, 2: {number["b"]: 1, number["d"]: 1}}


def test_awkward_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    docs = [(i, t) for i, t in rows if i not in (5, None)]
    check(spark, docs, [(i, t) for i, t in docs if i in (0, 1, 6, 8, 10, 12)], 5, 40_000)
    again = search.top_k(odd_docs, odd_docs.filter("doc_id = 8")).collect()
    assert [r.doc_id for r in again].count(5) == 2 and all(r.doc_id is not None for r in again)
    assert search.top_k(no_docs, odd_docs).count() == 0 and search.top_k(odd_docs, no_docs).count() == 0


def test_shares_of_postings_are_made_once():
    """A query at the weights the shard was finished with reads shares, not impacts; other weights and repeated words are made for it."""
    rng = random.Random(7)
    texts = [" ".join(rng.choices(["f0", "f1", "f2"], k=5) + rng.choices([f"r{i}" for i in range(900)], k=12)) for _ in range(1500)]
    vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    idf = np.array([0.1 if w[0] == "f" else 1 + i % 7 for i, w in enumerate(vocabulary)])
    plain, ready = (search.Shard.empty(vocabulary, len(vocabulary)) for _ in range(2))
    for shard in (plain, ready):
        for i, text in enumerate(texts):
            shard.add(i, text)
    plain.finish(17.0)
    ready.finish(17.0, idf)
    queries = []
    for text in texts[::60]:
        counts = Counter(text.split())
        t = np.array([vocabulary[w] for w in counts])
        queries.append((t, np.array(list(counts.values())) * idf[t]))
    for (a, b), (c, d) in zip(plain.search_many(queries, 4), ready.search_many(queries, 4), strict=True):
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist() and len(a) == 4
    t = np.array([vocabulary[w] for w in set(texts[0].split()) if w[0] == "r"])
    want = ready.search_many([(t, idf[t])], 4)[0]
    ready.impact = None
    again = ready.search_many([(t, idf[t])], 4)[0]
    assert want[0].tolist() == again[0].tolist() and want[1].tolist() == again[1].tolist()
