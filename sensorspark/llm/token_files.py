"""Token ids in binary files: every document a zstandard frame of its own, all frames with one dictionary.

`write` encodes a table of texts, trains a dictionary on serialized id arrays, compresses each
document by itself and writes files in ascending order of doc_id; `read` gives the documents back
from the files; `ShardFile` finds and reads single documents of a file without touching the others.

Folder layout. `dictionary/` holds one file with the dictionary, `shards/` the documents. A file is

    magic (8 bytes), SHA-256 of the dictionary (32), part, number in part, bytes an id takes (3 x u32),
    ids of the part that stand before this file (u64)
    frames, one after the other
    index, one entry per document: doc_id (i64), has a doc_id (u8), offset (u64), length (u32), ids (u64)
    documents (u64), offset of the index (u64), CRC-32 of the index (u32), magic (8), line feed (1)

all little-endian. Files go out through Spark's text sink, which writes any bytes, to whatever file
system the folder is on, and commits them once, so lost executors leave no half or double files.
The sink ends each file with the line feed. A file is closed when its frames reach `shard_bytes`.

The dictionary is a model of how ids follow each other: it is fitted on a bounded sample,
`sample_bytes` of texts, taken as pieces by a hash of id and content, each different piece once. It changes
sizes only, never what is read back. A corpus too small to train on gets an empty one.

Ids before a document: parts are ranges of doc_id, `parts` in number; a file knows the ids before it
in its part, and the parts' totals are one small table.

Texts are encoded by the `tokenizers` library. Byte-level pre-tokenizers always split before white
space and where runs of letters, digits and marks meet, so a text falls into stretches that
encode by themselves: each different one is encoded once. Texts with added tokens, or with control
characters on which Python and Unicode disagree, are encoded whole; with other pre-tokenizers all are.

Edge cases: a missing or empty text has the end id only. Rows without doc_id come first. Rows of one
doc_id, and rows without, stand in the order of a hash of their frames; equal rows are all kept. A
doc_id with a share of all rows is spread over parts. An empty table gives a folder without shards,
which reads as an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import struct
import sys
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.llm.common import documents
from sensorspark.plans.shared import materialize

MAGIC = b"TOKSHRD1"
HEAD = struct.Struct("<8s32sIIIQ")
FOOT = struct.Struct("<QQI8sc")
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("length", "<u4"), ("n", "<u8")])
LEVEL = 3
_CACHED_CHARS, _CACHED_WORDS = 48, 3 << 19
_SLICE_CHARS = 1 << 22
_PIECE = 8192

# White space and what follows it up to a place where every byte-level pre-tokenizer splits: the end of a run of Latin letters,
# digits or ASCII marks, unless some other character beyond ASCII or (after marks) an apostrophe follows; else up to the next white space.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_OTHER = "\x80-\u00bf\u00d7\u00f7\u0250-\U0010ffff"
_STRETCH = re.compile(rf"\s*(?:[{_LATIN}]++(?![{_OTHER}])|[0-9]++(?![{_OTHER}])|[!-&(-/:-@\[-`{{-~]++(?!['{_OTHER}])|\S+)|\s+")


class Encoder:
    """Ids of texts by the tokenizers library, serialized; built once per Python worker."""

    def __init__(self, spec: str) -> None:
        # One task has one core; set before the library starts threads of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        data = json.loads(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.width = 2 if self.tokenizer.get_vocab_size(True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        pre = data.get("pre_tokenizer") or {}
        own = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.splits = bool(own and not data.get("normalizer") and not data.get("post_processor"))
        self.stretches = _STRETCH.findall
        self.spaced = re.compile(r"\s[ \n]").search
        marks = [re.escape(t["content"]) for t in data.get("added_tokens", [])]
        self.odd = re.compile("|".join(["[\x1c-\x1f]", *marks])).search  # these are white space to Python, not to Unicode
        self.known: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        found = array(self.code, ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialized ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        plain, mixed = [], []
        for i, text in enumerate(texts):
            if not self.splits or self.odd(text):
                out[i] = self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
            elif self.spaced(text):
                mixed.append(i)
            else:
                plain.append(i)
        for group, way in ((plain, self._by_pieces), (mixed, self._by_stretches)):
            for i, found in zip(group, way([texts[i] for i in group]), strict=True):
                out[i] = found
        return out

    def _ids(self, units: list[str]) -> list[bytes]:
        """Ids of strings that encode by themselves; different ones are encoded once and mostly remembered."""
        known = self.known
        found = list(map(known.get, units))
        missing = list({u for u, f in zip(units, found, strict=True) if f is None})
        if missing:
            fresh: dict[str, bytes] = {}
            for at in range(0, len(missing), 8192):
                some = missing[at:at + 8192]
                fresh.update(zip(some, [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)], strict=True))
            found = [fresh[u] if f is None else f for u, f in zip(units, found, strict=True)]
            known.update((u, f) for u, f in fresh.items() if len(u) <= _CACHED_CHARS)
            if len(known) > _CACHED_WORDS:
                for u in list(known)[_CACHED_WORDS // 2:]:  # units seen first stay: common ones are among them
                    del known[u]
        return found

    def _by_stretches(self, texts: list[str]) -> list[bytes]:
        """Texts as joined stretches."""
        units = [self.stretches(t) for t in texts]
        ids = self._ids(list(chain.from_iterable(units)))
        cuts = np.cumsum([0, *map(len, units)]).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Texts whose blanks and line feeds stand alone: cut before each, different pieces encoded once, ids put together as arrays."""
        if not texts:
            return []
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        ends = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        firsts = [t.replace("\n", " \n").split(" ", 1)[0] for t in texts]  # the only pieces without a blank before them
        pieces = [w if w.startswith("\n") else " " + w for w in coded.dictionary.to_pylist()]
        ids = self._ids([*pieces, *firsts])
        code = coded.indices.to_numpy().astype(np.int64)
        code[ends[:-1]] = len(pieces) + np.arange(len(texts))
        lengths = np.array([len(i) for i in ids], np.int64) // self.width
        starts = np.cumsum(lengths) - lengths
        each = lengths[code]
        places = np.cumsum(each)
        from_ = np.repeat(starts[code] - (places - each), each) + np.arange(places[-1])
        found = np.frombuffer(b"".join(ids), f"u{self.width}")[from_]
        cuts = np.concatenate([[0], places])[ends]
        return [found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=1)
def encoder_of(spec: str) -> Encoder:
    return Encoder(spec)


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def train(pieces: list[bytes], size: int) -> bytes:
    """Dictionary of at most `size` bytes; empty if there is too little to learn from."""
    if sum(map(len, pieces)) < 16 * 1024 or len(pieces) < 16:
        return b""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b""


def _sampled(spec: Broadcast, share: float):
    """Hash and serialized ids of the pieces of texts whose hash lies in the first `share` of all hashes."""
    limit = int(share * (1 << 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, taken = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = (doc_id or 0) & 0xFFFFFFFF
                for at in range(0, len(text), _PIECE):
                    piece = text[at:at + _PIECE]
                    value = xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass"), seed)
                    if value < limit:
                        hashes.append(value - (1 << 63))
                        taken.append(piece)
            ids = encoder_of(spec.value).encode(taken) if taken else []
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(ids, pa.binary())], ["h", "ids"])
    return run


def fit_dictionary(docs: DataFrame, spec: Broadcast, dictionary_bytes: int, sample_bytes: int) -> bytes:
    """Dictionary from a hash sample of about `sample_bytes` of texts."""
    total = docs.agg(F.sum(F.octet_length("text").cast("decimal(38,0)"))).first()[0]
    if not total:
        return b""
    found = docs.mapInArrow(_sampled(spec, min(1.0, sample_bytes / int(total))), "h bigint, ids binary").dropDuplicates(["h"])
    return train([bytes(r["ids"]) for r in found.orderBy("h").collect()], dictionary_bytes)  # bounded by sample_bytes


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts, and where they start, of about _SLICE_CHARS characters."""
    start, some, size = 0, [], 0
    for text in texts:
        some.append(text.as_py())
        size += len(some[-1])
        if size >= _SLICE_CHARS:
            yield start, some
            start, some, size = start + len(some), [], 0
    if some:
        yield start, some


def _frames(spec: Broadcast, shared: Broadcast, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compress = encoder_of(spec.value), _compressor(shared.value).compress
        end = b"" if end_id is None else encoder._bytes([end_id])
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                ids = [found + end for found in encoder.encode(texts)]
                counts = pa.array([len(found) // encoder.width for found in ids], pa.int64())
                frames = pa.array([compress(found) for found in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ids)), counts, frames], ["doc_id", "n", "frame"])
    return run


class ShardWriter:
    """One file in memory."""

    def __init__(self, dictionary: bytes, part: int, number: int, width: int, before: int) -> None:
        self.body = bytearray(HEAD.pack(MAGIC, dictionary_hash(dictionary), part, number, width, before))
        self.entries: list[tuple] = []

    def add(self, doc_id: int | None, n: int, frame: bytes) -> None:
        self.entries.append((doc_id or 0, doc_id is not None, len(self.body), len(frame), n))
        self.body += frame

    def close(self) -> bytes:
        """The file without the line feed that the text sink adds."""
        index = np.array(self.entries, INDEX).tobytes()
        tail = FOOT.pack(len(self.entries), len(self.body), zlib.crc32(index), MAGIC, b"\n")
        return bytes(self.body) + index + tail[:-1]


class ShardFile:
    """A file opened for reading single documents: reads head, index and the frames asked for, nothing else."""

    def __init__(self, source: BinaryIO, dictionary: bytes) -> None:
        self.source = source
        magic, digest, self.part, self.number, self.width, self.before = HEAD.unpack(self._at(0, HEAD.size))
        size = source.seek(0, io.SEEK_END)
        count, at, check, last, _ = FOOT.unpack(self._at(size - FOOT.size, FOOT.size))
        if magic != MAGIC or last != MAGIC:
            raise ValueError("not a token file")
        if digest != dictionary_hash(dictionary):
            raise ValueError("the file was written with another dictionary")
        index = self._at(at, count * INDEX.itemsize)
        if zlib.crc32(index) != check:
            raise ValueError("damaged index")
        self.index = np.frombuffer(index, INDEX)
        self._decompress = _decompressor(dictionary).decompress

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, i: int) -> int | None:
        return int(self.index["doc_id"][i]) if self.index["known"][i] else None

    def ids(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file, as unsigned 32-bit integers."""
        entry = self.index[i]
        data = self._decompress(self._at(int(entry["offset"]), int(entry["length"])))
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> range:
        """Places of a doc_id in the file."""
        first = int((self.index["known"] == 0).sum())
        known = self.index["doc_id"][first:]
        return range(first + bisect_left(known, doc_id), first + bisect_left(known, doc_id + 1))


def _shards(shared: Broadcast, width: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, shard = TaskContext.get().partitionId(), 0, 0, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard.close()], pa.binary())], ["file"])

        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(c) for c in range(3)), strict=True):
                if shard is None:
                    shard = ShardWriter(shared.value, part, number, width, before)
                shard.add(doc_id.as_py(), n.as_py(), frame.as_py())
                before += n.as_py()
                if len(shard.body) >= shard_bytes:
                    yield closed()
                    shard, number = None, number + 1
        if shard is not None:
            yield closed()
    return run


def _write_bytes(files: DataFrame, path: str) -> None:
    """One file per row of a binary column, as it is, and a line feed."""
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def write(df: DataFrame, path: str, tokenizer: str, end_id: int | None = None, text: str = "text", doc_id: str = "doc_id",
          parts: int | None = None, shard_bytes: int = 8 << 20, dictionary_bytes: int = 64 << 10, sample_bytes: int = 4 << 20) -> None:
    """Encode the texts of a table and write them below `path`. `tokenizer` is a file of the driver; workers get its content."""
    spark = df.sparkSession
    spec = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    docs = documents(df, text, doc_id).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dictionary = fit_dictionary(docs, spec, dictionary_bytes, sample_bytes)
    shared = spark.sparkContext.broadcast(dictionary)
    frames = materialize(docs.mapInArrow(_frames(spec, shared, end_id), "doc_id bigint, n bigint, frame binary"), "frames")
    # The last two keys spread the rows of one doc_id, equal ones too.
    keys = [F.asc_nulls_first("doc_id"), F.xxhash64("frame"), F.col("_spread")]
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = frames.withColumn("_spread", F.rand(5)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys[:2], "frame")
    width = Encoder(spec.value).width
    _write_bytes(placed.mapInArrow(_shards(shared, width, shard_bytes), "file binary"), f"{path}/shards")
    _write_bytes(spark.createDataFrame([(bytearray(dictionary),)], "file binary"), f"{path}/dictionary")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(f"{path}/dictionary/*.txt").first()["content"])[:-1]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/shards").select("path", "content")


_COLUMNS = {"doc_id": "bigint", "part": "int", "number": "int", "place": "bigint", "before": "bigint", "n_tokens": "bigint",
            "ids_crc32": "bigint", "path": "string", "offset": "bigint", "length": "bigint"}


def _documents(shared: Broadcast, with_ids: bool):
    names = [*_COLUMNS, *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                file = ShardFile(io.BytesIO(content.as_py()), shared.value)
                before = file.before + np.concatenate([[0], np.cumsum(file.index["n"].astype(np.int64))[:-1]])
                for start in range(0, len(file), 512):
                    at = range(start, min(start + 512, len(file)))
                    data = [file.ids(i).tobytes() for i in at]
                    part = file.index[start:start + 512]
                    columns = [
                        pa.array([file.doc_id(i) for i in at], pa.int64()), pa.array([file.part] * len(at), pa.int32()),
                        pa.array([file.number] * len(at), pa.int32()), pa.array(at, pa.int64()),
                        pa.array(before[start:start + 512], pa.int64()), pa.array(part["n"].astype(np.int64)),
                        pa.array([zlib.crc32(d) for d in data], pa.int64()), pa.array([path.as_py()] * len(at), pa.string()),
                        pa.array(part["offset"].astype(np.int64)), pa.array(part["length"].astype(np.int64))]
                    if with_ids:
                        columns.append(pa.array(data, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names)
    return run


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of a written folder: doc_id, start, n_tokens, ids_crc32, path, offset, length of its frame.

    `start` counts the ids of all documents before it. `with_ids` adds `ids`, little-endian unsigned 32-bit integers.
    """
    shared = spark.sparkContext.broadcast(read_dictionary(spark, path))
    schema = ", ".join(f"{n} {t}" for n, t in _COLUMNS.items()) + (", ids binary" if with_ids else "")
    rows = materialize(_files(spark, path).mapInArrow(_documents(shared, with_ids), schema), "token-rows")
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("total")).collect()  # one row per part
    starts, total = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        starts[r["part"]] = total
        total += r["total"]
    base = F.get(F.array(*[F.lit(starts.get(p, 0)).cast("bigint") for p in range(max(starts) + 1)]), F.col("part")) if starts else F.lit(0)
    kept = ["n_tokens", "ids_crc32", "path", "offset", "length", *(["ids"] if with_ids else [])]
    return rows.select("doc_id", (base + F.col("before")).cast("bigint").alias("start"), *kept)
