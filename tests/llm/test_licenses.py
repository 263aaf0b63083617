import re

from sensorspark.llm import licenses as lic

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = sorted((i, label) for phrase, label in lic.PHRASES.items() for p in [phrase.split()]
                    for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p)
    return len(words), places


def rows_of(df):
    return [(r.doc_id, r) for r in lic.scan(df).collect()]


def test_documents_table(spark, folder):
    from sensorspark.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op8_license_scan"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, places = brute(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_templates_are_found_whole_and_in_noise(spark):
    noise = "some other words that stand around it "
    docs = [(i, noise * 20 + t.words.upper() + "! " + noise * 20) for i, t in enumerate(lic.TEMPLATES)]
    docs += [(100 + i, " ".join(reversed(t.words.split()))) for i, t in enumerate(lic.TEMPLATES)]
    docs.append((200, lic.TEMPLATES[5].words + " -- " + lic.TEMPLATES[3].words + " / " + lic.TEMPLATES[6].words))
    found = {i: {f.label for f in r.found} for i, r in rows_of(spark.createDataFrame(docs, "doc_id long, text string"))}
    for i, t in enumerate(lic.TEMPLATES):
        assert t.label in found[i], t.label
        assert not found[100 + i]
    assert {"mit-text", "apache-2.0", "bsd"} <= found[200]


def test_one_changed_word_is_forgiven_a_missing_key_is_not(spark):
    bsd = "redistribution and use in source and binary forms, with or without modification, are PERMISSIBLE provided that the following conditions are met"
    docs = [(1, bsd), (2, bsd.replace("binary", "other")), (3, "gnu general public\nlicense. Mit License, mit-license xmit license; cc-by éapache license")]
    rows = dict(rows_of(spark.createDataFrame(docs, "doc_id long, text string")))
    assert [f.label for f in rows[1].found] == ["bsd"] and 0.8 <= rows[1].found[0].score < 1
    assert not rows[2].found
    assert rows[3].base_labels == ["cc-by", "gpl", "mit"] and [p.start for p in rows[3].places] == [0, 4, 6, 10]


def test_awkward_rows(spark, odd_docs, no_docs):
    texts = [(r.doc_id, brute(r.text)) for r in odd_docs.collect()]
    got = [(i, (r.n_words, [(p.start, p.label) for p in r.places])) for i, r in rows_of(odd_docs)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1][0])
    assert sorted(got, key=key) == sorted(texts, key=key)
    assert lic.scan(no_docs).count() == 0
    many = spark.createDataFrame([(1, "mit license " * 3000), (2, None)], "doc_id long, text string")
    rows = dict(rows_of(many))
    assert len(rows[1].places) == 3000 and rows[2].n_words == 0


def test_every_notice_of_a_file_is_found_beside_rarer_ones(spark):
    """bsd and mit-text bring over 24 words that stand nowhere else; the words of the other notices are common."""
    by = {t.label: t.words for t in lic.TEMPLATES}
    common = "released under the mit license this work is licensed under the gnu general public license version 3"
    docs = [(1, " / ".join([by["bsd"], by["mit-text"], by["mit-notice"]])), (2, " / ".join(t.words for t in lic.TEMPLATES)),
            (3, by["bsd"] + " / " + by["mit-text"]), (4, "mit license " + by["bsd"])]
    docs += [(100 + i, common) for i in range(50)]
    rows = dict(rows_of(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {f.label for f in rows[1].found} == {"bsd", "mit-text", "mit-notice"}
    assert {f.label for f in rows[2].found} == set(by) and {f.score for f in rows[2].found} == {1.0}
    assert {f.label for f in rows[3].found} == {"bsd", "mit-text"} and {f.label for f in rows[4].found} == {"bsd"}
    assert all({f.label for f in rows[i].found} == {"mit-notice", "gpl-3.0"} for i in range(100, 150))


def test_scores_equal_every_start_tried(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("text ilike '%license%' or text ilike '%cc%by%'").select("doc_id", "text")
    total, counted = lic.frequencies(docs)
    idf = lic.idf_weights(total, counted)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts
    for i, r in rows_of(docs):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in texts[i]))
        joined, want = f" {' '.join(words)} ", {}
        for t in lic.TEMPLATES:
            own = t.words.split()
            best = max((sum(idf[w] for k, w in enumerate(own) if 0 <= s + k < len(words) and words[s + k] == w)
                        for s in range(1 - len(own), len(words))), default=0.0) / sum(idf[w] for w in own)
            if best >= lic.AGREEMENT and all(f" {k} " in joined for k in t.keys):
                want[t.label] = round(best, 9)
        assert {f.label: round(f.score, 9) for f in r.found} == want
