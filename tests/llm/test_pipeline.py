import importlib.util

import pytest

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as cp  # noqa: E402


def stages(spark, docs, folder):
    out = []
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder).localCheckpoint()
        out.append(docs)
    return out


def test_every_stage_against_brute_force(spark, folder):
    from test_mixing import copies
    from test_pii import brute as pii_spans
    from test_quality_rules import brute as measured
    from test_simhash import brute_components, brute_fingerprint

    from sensorspark.llm import mixing
    from sensorspark.llm.queries import SHARES

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r for r in docs.collect()}
    kept, single, clean, mixed, coded = stages(spark, docs, folder)
    assert all(d.columns == docs.columns for d in (kept, single, clean, mixed))
    first = {r.doc_id: r.text for r in kept.collect()}
    for i, r in texts.items():
        n, _, _, _, repeats = measured(r.text)
        if n < 10 or 100 * repeats > 20 * n:
            assert i not in first
    want = brute_components([(brute_fingerprint(t), i) for i, t in first.items()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(want.values()))
    third = {r.doc_id: r for r in clean.collect()}
    for r in third.values():
        assert r.n_chars == len(r.text) and not pii_spans(r.text)
        if not pii_spans(texts[r.doc_id].text) and r.text != texts[r.doc_id].text:
            assert any(f"[{k.upper()}]" in r.text for k in ("mail_like", "ip_like", "number", "phone_like", "secret"))
    sizes = {}
    for r in third.values():
        sizes[r.source] = sizes.get(r.source, 0) + 1
    total, share = len(third), sum(SHARES.get(s, SHARES[mixing.REST]) for s in sizes)
    expected = sorted(i for i, r in third.items() for _ in range(copies(i, total * SHARES[r.source] / share / sizes[r.source], 17)))
    assert sorted(r.doc_id for r in mixed.collect()) == expected
    assert sorted(r.doc_id for r in coded.collect()) == expected


def test_run_equals_its_stages(spark, folder):
    if not importlib.util.find_spec("tokenizers"):
        pytest.skip("no tokenizers")
    from tokenizers import Tokenizer

    from sensorspark.llm.queries import TOKENIZER

    library = Tokenizer.from_file(TOKENIZER)
    last = stages(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    mixed = {r.doc_id: r.text for r in last[3].collect()}
    rows = cp.run(spark, folder).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in rows) == sorted((r.doc_id, r.ids_sha256) for r in last[4].collect())
    for r in rows[:40]:
        assert r.n_tokens == len(library.encode(mixed[r.doc_id], add_special_tokens=False).ids)


def test_awkward_rows(spark, odd_docs, no_docs, folder):
    for d in stages(spark, odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), folder)[:-1]:
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [d.count() for d in stages(spark, no_docs.select("doc_id", "text", "lang", "source", "n_chars"), folder)] == [0] * 5
