import io
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorspark.llm import queries
from sensorspark.llm import token_files as t
from sensorspark.plans.shared import new_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
ENCODER = t.Encoder(Path(VOCABULARY).read_text())


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0  'sStdD<|>endoftext1,.!é日́×ɏʼªß"), st.characters(codec="utf-8")), max_size=60))
def test_stretches_encode_like_the_library(text):
    assert np.frombuffer(ENCODER.encode([text])[0], "<u2").tolist() == library(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "it's", "é.", "x9", "日本", "don't", "<|", ",,", "A"]), max_size=9).map(
    lambda words: "".join(w + " \n"[len(w) % 2] for w in words)), max_size=5))
def test_pieces_encode_like_the_library(texts):
    assert [np.frombuffer(b, "<u2").tolist() for b in ENCODER.encode(texts)] == [library(t) for t in texts]


def test_special_tokens_and_long_words():
    for text in ("<|endoftext|>", " a <|endoftext|>\n\n<|endoftext|>b  ", "x" * 3000 + " y", "   b  ", "it's  they'll\n 's"):
        assert np.frombuffer(ENCODER.encode([text])[0], "<u2").tolist() == library(text)


def expected(rows):
    """(doc_id, start, n, crc) for rows in file order, and the same without order inside one doc_id."""
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*library(text), 2]
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def round_trip(spark, df, **options):
    path = new_path(spark, "token-files")
    t.write(df, path, VOCABULARY, end_id=2, **options)
    return path, t.read(spark, path, with_ids=True).collect()


@pytest.mark.parametrize("shard_bytes", [1, 2000, 1 << 23])
def test_files_hold_every_document_in_order(spark, folder, shard_bytes):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path, rows = round_trip(spark, docs, shard_bytes=shard_bytes, parts=3)
    want = expected(sorted((r.doc_id, r.text) for r in docs.collect()))
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert all(crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 for r in rows)
    dictionary = t.read_dictionary(spark, path)
    assert dictionary and (len({r.path for r in rows}) > 3) == (shard_bytes < 1 << 20)
    r = rows[len(rows) // 2]
    with open(r.path.removeprefix("file:"), "rb") as f:
        file = t.ShardFile(f, dictionary)
        at = file.find(r.doc_id)
        assert len(at) == 1 and file.doc_id(at[0]) == r.doc_id and file.ids(at[0]).tobytes() == bytes(r.ids)
        assert not len(file.find(-5))


def test_one_document_reads_few_bytes(spark):
    class Counting(io.BytesIO):
        taken = 0

        def read(self, size=-1):
            data = super().read(size)
            self.taken += len(data)
            return data

    shard = t.ShardWriter(b"", 0, 0, 2, 10)
    press = t._compressor(b"").compress
    rng = np.random.default_rng(1)
    bodies = [rng.integers(0, 50000, 20000).astype("<u2").tobytes() for _ in range(50)]
    for i, body in enumerate(bodies):
        shard.add(2 * i, len(body) // 2, press(body))
    source = Counting(shard.close() + b"\n")
    file = t.ShardFile(source, b"")
    assert file.before == 10 and file.ids(file.find(40)[0]).astype("<u2").tobytes() == bodies[20] and not len(file.find(41))
    assert source.taken < len(source.getvalue()) / 20
    with pytest.raises(ValueError, match="another dictionary"):
        t.ShardFile(io.BytesIO(source.getvalue()), b"other")
    damaged = bytearray(source.getvalue())
    damaged[-60] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        t.ShardFile(io.BytesIO(bytes(damaged)), b"")


def test_odd_rows(spark, odd_docs):
    rows = odd_docs.collect()
    _, got = round_trip(spark, odd_docs, parts=4)
    key = lambda doc_id: (doc_id is not None, doc_id or 0)
    assert sorted((key(r.doc_id), r.ids_crc32, r.n_tokens) for r in got) == sorted(
        (key(r.doc_id), crc([*library(r.text), 2]), len(library(r.text)) + 1) for r in rows)
    got.sort(key=lambda r: r.start)
    assert [key(r.doc_id) for r in got] == sorted(key(r.doc_id) for r in rows)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()


def test_one_doc_id_is_spread_over_parts(spark):
    df = spark.range(4000).selectExpr("7L AS doc_id", "'the same text in every row' AS text")
    _, got = round_trip(spark, df, parts=4)
    assert len(got) == 4000 and len({r.path for r in got}) == 4
    assert sorted(r.start for r in got) == [got[0].n_tokens * i for i in range(4000)]


def test_empty_table(spark, no_docs):
    assert round_trip(spark, no_docs)[1] == []


def test_query_covers_the_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = queries.op12(spark, folder).collect()
    assert sorted(map(tuple, got)) == expected(sorted((r.doc_id, r.text) for r in docs))
