import re
from collections import Counter

from pyspark.sql import functions as F

from sensorspark.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    covered = {p for i, g in enumerate(grams) if times[g] > 1 for p in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measurements_equal_brute_force(spark, odd_docs):
    texts = Counter((r.doc_id, brute(r.text or "")) for r in odd_docs.collect())
    got = q.ledger(odd_docs).collect()
    assert Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == texts
    for r in q.apply_policy(q.ledger(odd_docs), q.POLICIES["v2"]).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_repeats():
    w = [b"a"] * 6
    assert q.repeated_words(w) == 6 and q.repeated_words(w[:5]) == 0
    assert q.repeated_words(b"a b c d e x a b c d e".split()) == 10
    assert q.repeated_words(b"a b a b a b a b".split()) == 8


def test_rules_follow_their_bits(spark):
    texts = {0: "few words", 1: "one two three four five " * 4, 2: " ".join(f"w{i}# ##" for i in range(20)),
             3: " ".join(str(i % 10) for i in range(12)), 4: "\n".join(["alpha beta gamma delta"] * 3 + ["x y z w v u t s r q"]),
             5: " ".join(f"word{i} |" for i in range(20)), 6: " ".join(f"word{i}!!" for i in range(20)),
             7: " ".join(f"WORDS{i}" for i in range(20))}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bits = {r.doc_id: r.fail_bits for r in q.ledger(df).collect()}
    for i in texts:
        assert bits[i] >> i & 1, q.RULES[i]


def test_policies_and_ablation(spark, folder):
    entries = q.ledger(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = entries.collect()
    policy = q.POLICIES["v2"]

    def kept(bits):
        return not (bits & q.mask(policy.hard) or bin(bits & q.mask(policy.soft)).count("1") > policy.allowed)

    got = {r.rule: r for r in q.ablate(entries, policy).collect()}
    for i, rule in enumerate(q.RULES):
        assert got[rule].failed == sum(r.fail_bits >> i & 1 for r in rows)
        assert got[rule].failed_alone == sum(r.fail_bits == 1 << i for r in rows)
        assert got[rule].freed == sum(not kept(r.fail_bits) and kept(r.fail_bits & ~(1 << i)) for r in rows)


def test_clean_documents_stay(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = q.apply_policy(q.ledger(docs), q.POLICIES["v2"]).join(labels, "doc_id").filter("not base_failed")
    by = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) == 0 and by.get((0, True), 0) <= 0.2 * sum(n for (x, _), n in by.items() if x == 0)


def test_stage_keeps_columns_and_rows(spark, odd_docs, no_docs):
    out = q.keep_documents(odd_docs.withColumn("_ledger", F.lit(1)), q.POLICIES["v2"])
    assert out.columns == [*odd_docs.columns, "_ledger"]
    judged = q.apply_policy(q.ledger(odd_docs), q.POLICIES["v2"])
    assert out.count() == judged.filter("kept").count() > 0
    assert q.ledger(no_docs).count() == 0 and q.keep_documents(no_docs, q.POLICIES["v1"]).count() == 0
    assert q.ablate(q.ledger(no_docs), q.POLICIES["v1"]).count() == 0
