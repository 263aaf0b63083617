import hashlib
import re

import pytest

from sensorspark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    kinds = (("email", EMAIL, lambda m: True),
             ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
             ("card", CARD, lambda m: 13 <= len(digits(m)) <= 19 and _luhn(digits(m))),
             ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15))
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in p.finditer(text) if ok(m)]


TEXTS = [
    "", None, "plain words only", "a@b.c", "x.y+z@mail.example.com, é ü 日 q@r.st.", "a@b.c+d@e.f", "a@b@c.d", "a@b.c.d@e.f",
    "ip 1.2.3.4 and 300.1.1.1 or 1.2.3.4.5 001.002.003.255 9.9.9", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111",
    "+1 (743) 555-3824 +12 3 +1 23 4567 890123456789", "++1 (((( +9 8", "😀 +44 20 7946 0958 😀 j@k.lm", "1 2 3 4-5-6  7 8", "x" * 20000,
    "5" * 20000, "a." * 5000 + "@b", "1." * 8000, "@" * 5000, "9 " * 4000, "mail u@v.w " * 700,
    "token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" done", "1.2.3.4" * 30, "a@b.c" * 50,
]


def test_strict_spans_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string")
    for r in pii.detect(df).collect():
        want = brute(TEXTS[r.doc_id] or "")
        assert [(s.kind, s.start, s.end) for s in r.strict] == want, r.doc_id
        assert [(s.kind, s.start, s.end) for s in r.spans][: len(want)] == want


def test_documents_table(spark, folder):
    from sensorspark.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op10_pii_spans"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in want) for k in pii.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans.startswith(joined)


def test_learned_spans_follow_format_and_context(spark):
    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)]
    rows = [(i, f"word here token = \"{k}\" and after") for i, k in enumerate(keys)]
    rows += [(1000 + i, f"see part-number-of-item-{i}-in-the-list now") for i in range(300)]
    found = {r.doc_id: r for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all([s.kind for s in found[i].spans] == ["secret"] for i in range(300))
    assert all(rows[i][1][found[i].spans[0].start: found[i].spans[0].end] == keys[i] for i in range(300))
    assert not any(found[1000 + i].spans for i in range(300))


def test_redaction(spark, odd_docs, no_docs):
    df = spark.createDataFrame([(1, "write a@b.c or +44 20 7946 0958!", "l"), (2, "é 1.2.3.4", None), (3, None, None), (None, "x@y.z", "m")],
                               "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert out[1].text == "write [EMAIL] or [PHONE]!" and out[1].lang == "l"
    assert out[2].text == "é [IP]" and out[3].text is None and out[None].text == "[EMAIL]"
    assert pii.redact(odd_docs).columns == odd_docs.columns
    assert pii.redact(odd_docs).count() == odd_docs.count() == pii.detect(odd_docs).count()
    assert pii.detect(no_docs).count() == 0 and pii.redact(no_docs).count() == 0


@pytest.mark.parametrize("kinds", [("email", "email"), ("phone", "number")])
def test_overlapping_spans_give_one_mark(spark, kinds):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("ab 12345 cd", [(kinds[0], 3, 6), (kinds[1], 4, 8)])],
                               "text string, spans array<struct<kind:string,start:bigint,end:bigint>>")
    assert df.select(pii.redacted(F.col("text"), F.col("spans"))).first()[0] == f"ab [{kinds[0].upper()}] cd"
