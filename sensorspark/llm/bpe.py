"""BPE encoding and decoding as streaming transducers.

Encoding. A word (a match of the pre-tokenizer) is read symbol by symbol through a window. How
far right of a token's end a symbol can still change it is bounded by the merge list:
`sufficient_lookahead` computes that bound, so every token that ends at least so far before the
end of the window is stable and leaves it. Memory is the window, whatever the word's length;
what follows a token boundary is encoded as if the word began there. Words within the window are
kept in a cache of bounded size.

Decoding. Tokens become bytes and pass an incremental UTF-8 machine that holds back at most the
bytes of one unfinished character. Tokenizers without a decoder join their tokens by blanks.

Reads the JSON files of the `tokenizers` library: BPE models with byte-level symbols, optional
end-of-word suffix, special tokens that are found in the raw text. A merge list in which a merge
uses a part that no earlier merge makes is refused: the lookahead argument needs that order.

Edge cases: a missing text is an empty one and gives no ids; missing ids decode to an empty
text; row order, repeats, missing document ids and other columns do not matter. An id outside
the vocabulary is skipped, as the library does.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sensorspark.llm.common import documents

CACHE_WORDS = 1 << 17
_BITS = 24
_MASK = (1 << _BITS) - 1
_NO_MERGE = 1 << 62
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SLICE_CHARS = 2_000_000
DECODE_BLOCK = 1 << 16
# The pattern of byte-level pre-tokenizers that split by themselves.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The visible character that byte-level vocabularies use for each byte."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Symbols after the end of a token that can still decide on it.

    `merges` are (left, right, made) in order of rank. A merge of u and v fails only if an
    earlier-ranked merge takes v, or u, to the right first, or if a merge inside them fails.
    `reach[m]` bounds how far beyond the end of its text what decides on m can lie.
    """
    made_by: dict[int, int] = {}
    # Per left part: ranks of its merges, and the running maximum of their text right of it plus reach.
    ranks: dict[int, list[int]] = {}
    most: dict[int, list[int]] = {}
    reach: list[int] = []
    best = 0
    for rank, (u, v, made) in enumerate(merges):
        far = 0
        for part, inside in ((v, 0), (u, length[v])):
            if part in made_by:
                far = max(far, reach[made_by[part]] - inside)
            if n := bisect_left(ranks.get(part, []), rank):
                far = max(far, most[part][n - 1] - inside)
        reach.append(far)
        made_by.setdefault(made, rank)
        right = length[v] + far
        best = max(best, right)
        ranks.setdefault(u, []).append(rank)
        running = most.setdefault(u, [])
        running.append(max(right, running[-1] if running else 0))
    return best


class Transducer:
    """Encoder and decoder of one vocabulary; built once per Python worker."""

    def __init__(self, spec: str, cache_words: int = CACHE_WORDS) -> None:
        data = json.loads(spec)
        model = data["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE models")
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.symbols = byte_symbols()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        known = {s + end for s in self.symbols for end in {"", self.suffix}}
        length = {vocab[s]: 1 for s in known if s in vocab}
        merges = []
        for left, right in pairs:
            if left not in known or right not in known:
                raise ValueError(f"merge of {left!r} and {right!r} comes before its parts")
            known.add(left + right)
            u, v, made = vocab[left], vocab[right], vocab[left + right]
            length.setdefault(made, length[u] + length[v])
            merges.append((u, v, made))
        # Pair -> rank and product, both sides packed into one integer.
        self.merge = {u << _BITS | v: rank << _BITS | made for rank, (u, v, made) in reversed(list(enumerate(merges)))}
        self.length = length
        self.lookahead = sufficient_lookahead(merges, length)
        self.window = 2 * self.lookahead + max(length.values())
        self.pairs = np.array([*sorted(self.merge), 1 << 62], np.int64)  # the last stands for pairs beyond all others
        self.pair_codes = np.array([self.merge.get(p, _NO_MERGE) for p in self.pairs.tolist()], np.int64)
        self.inner = [vocab.get(s) for s in self.symbols]
        self.final = [vocab.get(s + self.suffix) for s in self.symbols]
        whole = None not in self.inner and None not in self.final
        self.inner_table, self.final_table = (np.array(s, np.int64) if whole else None for s in (self.inner, self.final))
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        splits_at_space = self._text_side(data)
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i) for i in range(max(names) + 1)]
        self.joined_by_blanks = data.get("decoder") is None
        to_byte = {s: b for b, s in enumerate(self.symbols)}
        self.raw = [b"" if t is None else t.encode() if self.joined_by_blanks or not all(c in to_byte for c in t)
                    else bytes(to_byte[c] for c in t) for t in self.names]
        self.cache = _Cache(self._word, self.window, cache_words)
        # Words that hold no white space can be looked up by the chunk between two white spaces.
        self.chunks = _Cache(self._chunk, self.window, cache_words) if self.blanks and splits_at_space else None

    def _text_side(self, data: dict) -> bool:
        """Normalizer and pre-tokenizer; true if no word can hold white space."""
        normalizer, pre = data.get("normalizer") or {"type": "Sequence", "normalizers": []}, data["pre_tokenizer"]
        steps = normalizer.get("normalizers", [normalizer])
        pres = pre.get("pretokenizers", [pre])
        kinds = {s["type"] for s in steps}
        if kinds - {"NFC", "Replace", "Lowercase"} or any(s.get("pattern") != {"Regex": r"\s+"} for s in steps if s["type"] == "Replace"):
            raise ValueError("unknown normalizer")
        if any(p["type"] not in ("Split", "ByteLevel") or p.get("add_prefix_space") for p in pres):
            raise ValueError("unknown pre-tokenizer")
        self.nfc, self.lower, self.blanks = "NFC" in kinds, "Lowercase" in kinds, "Replace" in kinds
        splits = [p for p in pres if p["type"] == "Split"]
        if any(not p["invert"] or p["behavior"] != "Removed" for p in splits) or len(splits) > 1:
            raise ValueError("unknown split")
        pattern = splits[0]["pattern"]["Regex"] if splits else BYTE_LEVEL_PATTERN
        # White space as Unicode defines it, which is what the library's expressions mean by \s.
        pattern = pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern).findall
        self.odd_space = regex.compile(r"[\x1c-\x1f]").search  # white space to str.split, but not to Unicode
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        return bool(splits) and " " not in pattern and r"[^\p{White_Space}" in pattern and pattern.count("White_Space") == 1

    def normalized(self, text: str) -> str:
        if self.nfc and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()  # each character by itself: no final sigma
        return text

    def _merged(self, ids: list[int]) -> list[int]:
        """All merges of a window, lowest rank first, leftmost first."""
        get = self.merge.get
        codes = [get(u << _BITS | v, _NO_MERGE) for u, v in zip(ids, ids[1:], strict=False)]
        while codes and (code := min(codes)) != _NO_MERGE:
            i, made = codes.index(code), code & _MASK
            ids[i] = made
            del ids[i + 1], codes[i]
            if i:
                codes[i - 1] = get(ids[i - 1] << _BITS | made, _NO_MERGE)
            if i < len(codes):
                codes[i] = get(made << _BITS | ids[i + 1], _NO_MERGE)
        return ids

    def tokens(self, word: str) -> Iterator[int]:
        """Ids of one word, given out as soon as they are stable."""
        data = word.encode("utf-8", "surrogatepass")
        waiting: list[int] = []
        last = len(data) - 1
        for at, byte in enumerate(data):
            symbol = (self.final if at == last else self.inner)[byte]
            if symbol is not None:
                waiting.append(symbol)
            if len(waiting) >= self.window and at < last:
                end = 0
                for token in self._merged(waiting[:]):
                    if end + self.length[token] > len(waiting) - self.lookahead:
                        break
                    end += self.length[token]
                    yield token
                waiting = waiting[end:]
        yield from self._merged(waiting)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out = []
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                part = self.normalized(part)
                if self.chunks is None or self.odd_space(part):
                    out.append(self._chunk(part))
                else:
                    out.append(b"".join(map(self.chunks.__getitem__, part.split())))
        return b"".join(out)

    def learn(self, chunks: set[str]) -> None:
        """Fill the caches with chunks they lack; their words are merged all together."""
        parts = {}
        for chunk in chunks:
            core = chunk.rstrip(_PUNCTUATION)
            if core.isalpha():  # letters, then marks: no need for the expression
                parts[chunk] = [core, chunk[len(core):]] if len(core) < len(chunk) else [core]
            elif len(chunk) <= self.window:
                parts[chunk] = self.words(chunk)
        new = {w for words in parts.values() for w in words} - self.cache.keys()
        if len(self.cache) + len(new) > self.cache.limit:
            self.cache.clear()
            new = {w for words in parts.values() for w in words}
        new = [w for w in new if len(w) <= self.window // 4]
        self.cache.update(zip(new, self._merged_together(new), strict=True))
        get = self.cache.__getitem__
        for chunk, words in parts.items():
            if len(chunk) <= self.window:
                self.chunks[chunk] = get(words[0]) if len(words) == 1 else b"".join(map(get, words))

    def _codes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and product of pairs, as in `merge`."""
        pairs = left << _BITS | right
        at = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[at] == pairs, self.pair_codes[at], _NO_MERGE)

    def _merged_together(self, words: list[str]) -> list[bytes]:
        """Packed ids of many short words: in each round every word makes its lowest, leftmost merge."""
        if not words:
            return []
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        data = np.frombuffer(b"".join(coded), np.uint8)
        ids = self.inner_table[data]
        ids[np.cumsum(sizes) - 1] = self.final_table[data[np.cumsum(sizes) - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words = [], []
        same = word[1:] == word[:-1]
        codes = np.append(np.where(same, self._codes(ids[:-1], ids[1:]), _NO_MERGE), _NO_MERGE)
        while len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(codes, first)
            lengths = np.diff(first, append=len(word))
            over = np.repeat(least == _NO_MERGE, lengths)
            done_ids.append(ids[over])
            done_words.append(word[over])
            low = np.repeat(least, lengths)[~over]
            ids, word, codes = ids[~over], word[~over], codes[~over]
            if not len(ids):
                break
            hit = np.flatnonzero(codes == low)
            hit = hit[np.diff(word[hit], prepend=-1) != 0]  # the leftmost of each word
            ids[hit] = codes[hit] & _MASK
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            moved = hit - np.arange(len(hit))  # where the products stand after the right parts are gone
            codes[hit] = codes[hit + 1]  # whether there is a next pair
            ids, word, codes = ids[keep], word[keep], codes[keep]
            for at in (moved, moved[moved > 0] - 1):
                at = at[at + 1 < len(ids)]
                at = at[word[at] == word[at + 1]]
                codes[at] = self._codes(ids[at], ids[at + 1])
            last = moved[(moved + 1 >= len(ids)) | (word[np.minimum(moved + 1, len(ids) - 1)] != word[moved])]
            codes[last] = _NO_MERGE
        flat, owner = np.concatenate(done_ids), np.concatenate(done_words)
        packed = flat[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """`encode` of each text; what the caches lack is merged all together first."""
        if self.chunks is None or self.inner_table is None:
            return list(map(self.encode, texts))
        plain = [None if self.odd_space(t) or (self.marks and self.marks.search(t)) else self.normalized(t).split() for t in texts]
        all_chunks = {c for chunks in plain if chunks for c in chunks}
        new = all_chunks - self.chunks.keys()
        if len(self.chunks) + len(new) > self.chunks.limit:
            self.chunks.clear()
            new = all_chunks
        self.learn(new)
        get = self.chunks.__getitem__
        return [self.encode(t) if chunks is None else b"".join(map(get, chunks)) for t, chunks in zip(texts, plain, strict=True)]

    def _chunk(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.words(text)))

    def _word(self, word: str) -> bytes:
        return array("I", self.tokens(word)).tobytes()

    def decode(self, ids: Iterable[bytes]) -> Iterator[str]:
        """Text of a stream of id blocks, piece by piece."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        joint, first, size = (b" " if self.joined_by_blanks else b""), True, len(self.names)
        for block in ids:
            some = np.frombuffer(block, "<u4")
            some = some[some < size].tolist()
            if not some:
                continue
            data = joint.join(map(self.raw.__getitem__, some))
            yield machine.decode(data if first else joint + data)
            first = False
        yield machine.decode(b"", True)


class _Cache(dict):
    """Packed ids by text; emptied when full and closed to long texts, so its size is bounded."""

    def __init__(self, make: Callable[[str], bytes], longest: int, limit: int) -> None:
        super().__init__()
        self.make, self.longest, self.limit = make, longest, limit

    def __missing__(self, key: str) -> bytes:
        packed = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = packed
        return packed


@lru_cache(maxsize=4)
def _transducer(spec: str) -> Transducer:
    return Transducer(spec)


def load(path: str) -> str:
    """The tokenizer file's text; read on the driver and sent to the workers once."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _blocks(ids: bytes) -> Iterator[bytes]:
    return (ids[i: i + 4 * DECODE_BLOCK] for i in range(0, len(ids), 4 * DECODE_BLOCK))


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about SLICE_CHARS bytes in the column, so that results leave in small batches."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    part = np.cumsum(sizes) // SLICE_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def encode(df: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", round_trip: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids): ids packed as little-endian unsigned 32-bit integers.

    With `round_trip` also `decoded`, the text of those ids, from the same worker and pass.
    """
    spec = df.sparkSession.sparkContext.broadcast(load(path))  # a vocabulary file, whose size does not follow the data
    docs = documents(df, text, doc_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(spec.value)
        for batch in batches:
            for part in _slices(batch, "text"):
                ids = machine.encode_many(part.column("text").to_pylist())
                out = [part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if round_trip:
                    out.append(pa.array(["".join(machine.decode(_blocks(i))) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    fields = [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if round_trip:
        fields.append(T.StructField("decoded", T.StringType()))
    names = [f.name for f in fields]
    return docs.mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The input with one more column, `decoded` (replaced if there): the text of the packed ids."""
    spec = df.sparkSession.sparkContext.broadcast(load(path))
    rest = df.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(spec.value)
        for batch in batches:
            for part in _slices(batch, ids):
                texts = ["".join(machine.decode(_blocks(r or b""))) for r in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("decoded", T.StringType())]))
