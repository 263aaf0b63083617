import hashlib
import os
import random

import numpy as np
import pytest

from sensorspark.llm import bpe

FOLDER = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    path = f"{FOLDER}/{request.param}"
    if not os.path.exists(path):
        pytest.skip("no tokenizer files")
    from tokenizers import Tokenizer

    return bpe.Transducer(bpe.load(path)), Tokenizer.from_file(path), path


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def texts():
    rng = random.Random(11)
    letters = [chr(c) for c in [*range(0x250), *range(0x370, 0x400), *range(0x2000, 0x2070), 0x3000, 0x85, 0x1680, 0x212A, 0x130, 0x3A3,
                                0x1F600, 0xFB01, 0x1100, 0x1161, 0x301, 0x308, 0xAC00, 0x4E2D]]
    out = ["", " ", "'s it's ΣΑΣ", "<|endoftext|>", "a<|startoftext|> b<|endoftext|>c", "x\x1cy \x85 z", "word... (word), WORD's"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    out += ["".join(rng.choice("abcdefghiinotesrl") for _ in range(rng.randint(300, 3000))) for _ in range(30)]
    return out + [w * 2000 for w in ("a", "th", "ion", "aaaaaab", "banana")]


def test_equals_the_library(both):
    own, library, _ = both
    cases = texts()
    for text, together in zip(cases, own.encode_many(cases), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(own.encode(text)) == want == ids(together), text[:50]
        packed = own.encode(text)
        blocks = [packed[i:i + 12] for i in range(0, len(packed), 12)]
        assert "".join(own.decode(blocks)) == library.decode(want, skip_special_tokens=False), text[:50]


def test_window_is_bounded_and_stable(both):
    own, _, _ = both
    word = "".join(random.Random(2).choice("abcdeinorst") for _ in range(20000))
    whole = list(own.tokens(word))
    small = bpe.Transducer.__new__(bpe.Transducer)
    small.__dict__.update(own.__dict__)
    small.window = len(word) + 1
    assert whole == list(small.tokens(word))
    sizes = []
    merged = own._merged
    small.window, small._merged = own.window, lambda w: sizes.append(len(w)) or merged(w)
    assert list(small.tokens(word)) == whole and max(sizes) <= own.window


def test_lookahead_of_a_chain():
    # cd before bc before ab: whether a and b merge is settled by the letter d, two after b.
    a, b, c, d, cd, bc, ab = range(7)
    length = dict.fromkeys((a, b, c, d), 1) | dict.fromkeys((cd, bc, ab), 2)
    assert bpe.sufficient_lookahead([(c, d, cd), (b, c, bc), (a, b, ab)], length) == 3
    assert bpe.sufficient_lookahead([(a, b, ab)], length) == 1


def test_merges_out_of_order_are_refused():
    import json

    spec = {"model": {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3}, "merges": ["ab a", "a b"]},
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "added_tokens": []}
    with pytest.raises(ValueError, match="before its parts"):
        bpe.Transducer(json.dumps(spec))


def test_small_caches_change_nothing(both):
    own, _, path = both
    small = bpe.Transducer(bpe.load(path), cache_words=8)
    cases = texts()[:120]
    assert small.encode_many(cases) == own.encode_many(cases) and len(small.cache) <= 8 + len(cases) * 60


def test_query_and_awkward_rows(spark, folder, odd_docs, no_docs, both):
    _, library, path = both
    if path.endswith(NAMES[0]):
        from sensorspark.llm.queries import QUERIES

        docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        for r in QUERIES["op9_bpe_stream"](spark, folder).collect():
            want = library.encode(docs[r.doc_id], add_special_tokens=False).ids
            assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    coded = bpe.encode(odd_docs, path)
    assert coded.columns == ["doc_id", "n_tokens", "ids"] and coded.count() == odd_docs.count()
    assert sorted(r.n_tokens for r in coded.filter("doc_id = 0").collect()) == [0]
    apart, together = bpe.decode(coded, path), bpe.encode(odd_docs, path, round_trip=True)
    assert sorted(map(repr, apart.collect())) == sorted(map(repr, together.collect()))
    assert bpe.decode(bpe.decode(coded, path), path).columns == [*coded.columns, "decoded"]
    assert bpe.decode(bpe.encode(no_docs, path), path).count() == 0
    missing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode(missing, path).first().decoded == ""
