import random
import re
from collections import Counter, defaultdict

import pytest
from oracle import compare, connect

from sensorspark.llm import collocations as c
from sensorspark.llm import queries

SCHEMA = "doc_id long, text string, lang string, phrase string, a string, n string"


def brute(rows, least, share, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i:i + size]] = max(longer[p[i:i + size]], a)
        best = []
        for p, a in candidates.items():
            if p in longer and 100 * longer[p] >= share * a:
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, "x", None, "y") for i, (lang, text) in enumerate(rows)], SCHEMA)


def texts(seed, count, words=12):
    r = random.Random(seed)
    vocabulary = ["New", "york", "city", "hall", "é", "日本", "a", "b", "c", "d", "x\x0by", "of", "the", "\x00", "NEW", "\xa0", "İ"][:words + 5]
    marks = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "!? "]
    return [(r.choice(["en", "en", "de", None, "", "und"]),
             "".join(r.choice(vocabulary) + r.choice(marks) for _ in range(r.randint(0, 60)))) for _ in range(count)]


@pytest.mark.parametrize(("least", "share", "top", "bits"), [(30, 80, 2000, 1 << 25), (3, 80, 2000, 64), (2, 50, 7, 1 << 12), (1, 100, 40, 1 << 16)])
def test_equals_brute_force(spark, least, share, top, bits):
    rows = texts(least, 150) + [("en", None), (None, ""), ("fr", "New York city hall " * 40), ("fr", "x. y")]
    rows += rows[:30]
    got = c.mine(table(spark, rows), least=least, share=share, top=top, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, share, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_small_slices_add_up(spark):
    rows = texts(9, 120)
    slices = []
    for lang, text in rows:
        s = c.Slice()
        s.add("und" if lang is None else lang, text)
        slices.append(c._elements(s.stripes(1, [], None, 4)))
    total = Counter()
    for r in c._added(slices).to_pylist():
        total[r["lang"]] += r["n"]
    whole = c.stripes(table(spark, rows), 1).filter("prefix = ''").collect()
    assert total == Counter({lang: sum(r.total for r in whole if r.lang == lang) for lang in {r.lang for r in whole}})


def test_stripes_hold_prefix_totals_and_are_split(spark):
    rows = [("en", f"hot w{i} end. hot w{i}") for i in range(3000)] * 2
    found = c.stripes(table(spark, rows), 2, filter_bits=1 << 16).collect()
    assert sum(r.total for r in found if r.prefix == "w7") == 4
    hot = [r for r in found if r.prefix == "hot"]
    assert 30 < len(hot) <= 64 and sum(r.total for r in hot) == 12000 and max(len(r.words) for r in hot) < 300
    assert {w: n for r in found if r.prefix == "hot w7" for w, n in zip(r.words, r.n, strict=True)} == {"end": 2}
    assert sum(r.total for r in found if r.prefix == "hot w7") == 4


def test_filter_never_misses(spark):
    rows = texts(4, 60)
    found = c.stripes(table(spark, rows), 2, filter_bits=1 << 10)
    phrases = {(r.lang, " ".join(filter(None, [r.prefix, w]))) for r in found.collect() for w in r.words}
    want = {(lang, p) for lang, _, p, *_ in brute(rows, 2, 10 ** 9, 10 ** 9)}
    assert want <= phrases


def test_empty_table(spark):
    assert c.mine(table(spark, [])).collect() == []
    assert c.mine(table(spark, [(None, None), ("en", " ,. ")])).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        c.mine(table(spark, []), filter_bits=100)


def test_odd_rows(spark, odd_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, c.mine(odd_docs, least=2).collect())) == brute(rows, 2, 80, 2000)


def test_query_matches_sql_and_brute_force(spark, folder):
    got = queries.op13(spark, folder)
    same, message = compare(got, connect(folder), queries.ORACLES["op13_collocations"])
    assert same, message
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert sorted(map(tuple, got.collect())) == brute([(r.lang, r.text) for r in docs], 30, 80, 2000)
