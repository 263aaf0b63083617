"""Phrases whose words occur together far more often than their parts apart, by stripes.

A stripe belongs to a prefix of 0 to 3 words and counts the words that follow it. Stripes of
a slice of text are added up in the task that reads it; stripes of one prefix are then merged
element by element. One structure answers everything: an entry is the count of prefix plus word (the
extensions), the sum of a stripe is the count of its prefix (what is followed by no counted
word, or by the end of a piece, is kept as a number of its own), and the greatest entries of the stripes say which
phrases a longer one takes over.

Stripes are built length by length. A phrase of at least `least` occurrences has only parts of at
least as many, so the stripes of a length count a word only after a prefix, and with an ending, that
can be as frequent. Tasks know those phrases by a bit filter of fixed size (`filter_bits`, a Bloom
filter that is broadcast): it lets no frequent phrase be missed, and a rare one that it lets pass is counted and
then dropped by its exact count. When phrases outgrow the filter the result is the same, only with
more counting; give more bits then.

Stripes travel in bundles: all stripes of a slice whose prefixes fall into one bucket are one row; there is a bucket for
every half megabyte of text. The stripes of a hot prefix (over 1/4096 of all words, so there are at most 4096 per length; the
empty prefix always) are dealt over buckets by the following word, so that none becomes one task's whole vocabulary.

Everything is per language. Edge cases: a missing language is `und`, an empty one is itself; a missing
text has no words; repeated rows count as often as they stand there; ids and other columns are not
read. A piece of one word counts for that word. An empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorspark.plans.shared import materialize

LONGEST = 4
FILTER_BITS = 1 << 25
SLICE_WORDS = 2_000_000
_SLICE_TYPES = 1 << 20
_END = b"\xff"  # no byte of UTF-8
_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else 255 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BUNDLE = ("bucket int, langs array<string>, prefixes array<string>, sizes array<int>, rest array<bigint>, "
           "words array<string>, n array<bigint>")
_STRIPE = "lang string, prefix string, total bigint, words array<string>, n array<bigint>, bits array<bigint>"
_HOT_SHARE, _HOT_PARTS = 4096, np.uint64(64)
_MERGE_ROWS = 1 << 20
_BUCKET_BYTES = 1 << 19


def _mixed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hashes of the phrase without its last word and of that word."""
    with np.errstate(over="ignore"):
        h = (prefix * _MIX ^ word) * np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ h >> np.uint64(29)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\t" + word)


def phrase_hash(lang: str, words: list[bytes]) -> int:
    """The hash that `_mixed` builds up."""
    h = np.array([word_hash(lang, words[0])], np.uint64)
    for w in words[1:]:
        h = _mixed(h, np.array([word_hash(lang, w)], np.uint64))
    return int(h[0])


class Filter:
    """Bits of a Bloom filter with two bits per phrase."""

    def __init__(self, bits: bytes, size: int) -> None:
        self.bits, self.mask = np.frombuffer(bits, np.uint8), np.uint64(size - 1)

    def __contains__(self, h: int) -> bool:
        return bool(self.passes(np.array([h], np.uint64))[0])

    def passes(self, h: np.ndarray) -> np.ndarray:
        first, second = h & self.mask, h >> np.uint64(32) & self.mask
        at = lambda p: self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1
        return (at(first) & at(second)).astype(bool)


def positions(h: int, size: int) -> tuple[int, int]:
    return h & (size - 1), h >> 32 & (size - 1)


class Slice:
    """Words of consecutive texts as numbers, 0 ending a piece; numbers tell languages apart."""

    def __init__(self) -> None:
        self.known: dict[str, dict[bytes, int]] = {}
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self.hashes = array("Q", [0])
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        found = text.encode("utf-8", "surrogatepass").translate(_TO_LOWER).replace(_END, b" \xff ").split(b" ")
        known = self.known.setdefault(lang, {b"": -1, _END: 0})
        for word in set(found).difference(known):
            known[word] = len(self.words)
            self.words.append(word)
            self.langs.append(lang)
            self.hashes.append(word_hash(lang, word))
        ids = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
        ids = np.append(ids[ids >= 0], 0)
        self.ids.append(ids)
        self.size += len(ids)

    def stripes(self, size: int, filters: list[Filter], hot: np.ndarray, buckets: int) -> pa.RecordBatch:
        """Bundles of the stripes of prefixes of size - 1 words.

        `filters` know the frequent phrases of 1 to size - 1 words, `hot` has the hashes of hot prefixes.
        """
        ids, hashes = np.concatenate(self.ids), np.array(self.hashes, np.uint64)
        # at[i]: may the phrase that starts at i be frequent; its number and hash (of the prefix, then of the ending).
        prefix, h = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.uint64)
        passes, first = ids > 0, np.zeros(1, np.int64)
        ending = passes if size == 1 else passes & filters[0].passes(hashes)[ids]
        for length in range(1, size):
            if length == 1:
                passes, prefix, h = ending, ids, hashes[ids]
                first = np.arange(len(self.words))  # where a number occurs, as a place in `ids`
                first[ids[::-1]] = np.arange(len(ids))[::-1]
            else:
                # The phrase of `length` words at i is that of length - 1 at i and the word after it.
                last = np.append(ids[length - 1:], np.zeros(length - 1, np.int64))
                after = np.append(passes[1:], False)
                passes = passes & after & (last > 0)
                h = _mixed(h, hashes[last])
                passes[passes] = filters[length - 1].passes(h[passes])
                place = np.flatnonzero(passes)
                _, at, number = np.unique(prefix[place] * len(self.words) + last[place], return_index=True, return_inverse=True)
                prefix = np.zeros(len(ids), np.int64)
                prefix[place], first = number, place[at]
            ending = passes
        place = np.flatnonzero(passes)
        reach = size - 1
        following = np.append(ids[reach:], np.zeros(reach, np.int64))[place]
        counted = np.append(ending, [False])[place + 1] if size > 1 else np.ones(len(place), bool)
        key, n = np.unique(prefix[place] * len(self.words) + np.where(counted & (following > 0), following, 0), return_counts=True)
        return self._bundles(size, key // len(self.words), key % len(self.words), n, first, ids, h, hashes, hot, buckets)

    def _bundles(self, size, prefix, word, n, first, ids, h, hashes, hot, buckets) -> pa.RecordBatch:
        """Rows of _BUNDLE from counts of (prefix, following word); word 0 stands for all that are not counted."""
        names = sorted(self.known)
        if size == 1:  # the empty prefix of each language, always hot
            number = {lang: i for i, lang in enumerate(names)}
            prefix = np.array([number[self.langs[w]] for w in word.tolist()], np.int64)
            start, split = np.zeros(len(prefix), np.uint64), np.ones(len(prefix), bool)
        else:
            start = h[first[prefix]]
            split = np.isin(start, hot)
        part = np.where(split & (word > 0), hashes[word] % _HOT_PARTS if size > 1 else hashes[word], np.uint64(0))
        bucket = (_mixed(start, part) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((word, prefix, bucket))
        prefix, word, n, bucket = prefix[order], word[order], n[order], bucket[order]
        new = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(prefix, prepend=-1) != 0))
        own = np.flatnonzero(np.diff(bucket[new], prepend=-1))  # the first stripe of each bundle
        keep = word > 0
        rest = np.add.reduceat(np.where(keep, 0, n), new) if len(new) else n
        ends = np.concatenate([np.concatenate([[0], np.cumsum(keep)])[new], [keep.sum()]])
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        if size == 1:
            langs = pa.array(names, pa.string()).take(pa.array(prefix[new]))
            text = pa.array([""] * len(new), pa.string())
        else:
            at = first[prefix[new]]
            langs = pa.array(self.langs, pa.string()).take(pa.array(ids[at]))
            text = words.take(pa.array(ids[at]))
            for i in range(1, size - 1):
                text = pc.binary_join_element_wise(text, words.take(pa.array(ids[at + i])), " ")
        bundles = pa.array(np.append(own, len(new)), pa.int32())
        inner = pa.array(ends[np.append(own, len(new))], pa.int32())
        stripe, element = (lambda v: pa.ListArray.from_arrays(bundles, v)), (lambda v: pa.ListArray.from_arrays(inner, v))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[new][own], pa.int32()), stripe(langs), stripe(text), stripe(pa.array(np.diff(ends), pa.int32())),
             stripe(pa.array(rest, pa.int64())), element(words.take(pa.array(word[keep]))), element(pa.array(n[keep], pa.int64()))],
            ["bucket", "langs", "prefixes", "sizes", "rest", "words", "n"])


def _read(size: int, shared: list[Broadcast], hot: np.ndarray, bits: int, buckets: int):
    """Stripes of the texts of a task, added up slice by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [Filter(s.value, bits) for s in shared]
        current = Slice()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                current.add(lang.as_py(), text.as_py())
                if current.size >= SLICE_WORDS or len(current.words) >= _SLICE_TYPES:
                    yield from _small(current.stripes(size, filters, hot, buckets))
                    current = Slice()
        if current.size:
            yield from _small(current.stripes(size, filters, hot, buckets))
    return run


def _small(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, 256):
        yield batch.slice(start, 256)


def _elements(bundles: pa.RecordBatch) -> pa.Table:
    """Bundles as rows (lang, prefix, word, n); a missing word has what is not counted by itself."""
    flat = [bundles.column(c).flatten() for c in range(1, 7)]
    langs, prefixes, sizes, rest, words, n = flat
    owner = pa.array(np.repeat(np.arange(len(langs)), sizes.to_numpy()))
    other = pa.array(np.flatnonzero(rest.to_numpy()))
    none = pa.nulls(len(other), pa.string())
    columns = [(langs.take(owner), langs.take(other)), (prefixes.take(owner), prefixes.take(other)), (words, none), (n, rest.take(other))]
    return pa.table([pa.chunked_array(list(c)) for c in columns], ["lang", "prefix", "word", "n"])


def _added(tables: list[pa.Table]) -> pa.Table:
    """Stripes merged element by element."""
    return pa.concat_tables(tables).group_by(["lang", "prefix", "word"]).aggregate([("n", "sum")]).rename_columns(["lang", "prefix", "word", "n"])


def _merged(tables: list[pa.Table], least: int, bits: int) -> pa.RecordBatch:
    """Stripes of one bucket; words under `least` go into the total only."""
    found = _added(tables).sort_by([(c, "ascending") for c in ("lang", "prefix", "word")]).combine_chunks()
    lang, prefix, word = (pa.concat_arrays(found[c].chunks) for c in ("lang", "prefix", "word"))
    n = found["n"].to_numpy()
    keys = pc.binary_join_element_wise(lang, prefix, "\t").dictionary_encode().indices.to_numpy()
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    keep = (n >= least) & word.is_valid().to_numpy(zero_copy_only=False)
    ends = np.concatenate([np.concatenate([[0], np.cumsum(keep)])[new], [keep.sum()]])
    at = np.flatnonzero(keep)
    places: list[int] = []
    if bits:
        for a, b, c in zip(lang.take(pa.array(at)).to_pylist(), prefix.take(pa.array(at)).to_pylist(), word.take(pa.array(at)).to_pylist(), strict=True):
            words = [w.encode("utf-8", "surrogatepass") for w in ([*b.split(" "), c] if b else [c])]
            places += positions(phrase_hash(a, words), bits)
    lists = lambda values, scale=1: pa.ListArray.from_arrays(pa.array(ends * scale, pa.int32()), values)
    return pa.RecordBatch.from_arrays(
        [lang.take(pa.array(new)), prefix.take(pa.array(new)), pa.array(np.add.reduceat(n, new), pa.int64()), lists(word.take(pa.array(at))),
         lists(pa.array(n[at], pa.int64())), lists(pa.array(places, pa.int64()), 2 if bits else 0)],
        ["lang", "prefix", "total", "words", "n", "bits"])


def _merge(least: int, bits: int):
    """Bundles sorted by bucket, those of one bucket added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, rows = None, [], 0
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for start, end in zip(starts, [*starts[1:], len(bucket)], strict=True):
                if bucket[start] != current:
                    if held:
                        yield _merged(held, least, bits)
                    current, held, rows = bucket[start], [], 0
                held.append(_elements(batch.slice(start, end - start)))
                rows += held[-1].num_rows
                if rows > _MERGE_ROWS:
                    held = [_added(held)]
                    rows = held[0].num_rows // 2
        if held:
            yield _merged(held, least, bits)
    return run


def _filter(merged: DataFrame, bits: int) -> bytes:
    """The filter of the phrases that stripes ended in; at most bits / 32 numbers come to the driver."""
    place = merged.select(F.explode("bits").alias("p"))
    words = place.groupBy(F.expr("cast(p div 32 AS int)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 32 AS int)))").alias("v"))
    out = np.zeros(bits // 32, np.uint32)
    found = words.toArrow()
    out[found["w"].to_numpy()] = found["v"].to_numpy().astype(np.uint32)
    return out.tobytes()


def stripes(df: DataFrame, least: int, text: str = "text", lang: str = "lang", filter_bits: int = FILTER_BITS) -> DataFrame:
    """Merged stripes of prefixes of 0 to 3 words: lang, prefix, part, total, words, n; words with counts of at least `least`.

    `total` counts the prefix itself (all words of the language for the empty one).
    """
    if filter_bits & filter_bits - 1 or filter_bits < 64:
        raise ValueError("filter_bits must be a power of two, at least 64")
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text").cast("decimal(38,0)"))).first()[0] or 0
    buckets = min(1 << 20, max(64, int(size) // _BUCKET_BYTES))
    shared: list[Broadcast] = []
    levels, hot, words = [], np.zeros(0, np.uint64), 0
    for size in range(1, LONGEST + 1):
        found = texts.mapInArrow(_read(size, [*shared], hot, filter_bits, buckets), _BUNDLE)
        keyed = found.repartition("bucket").sortWithinPartitions("bucket")
        merged = materialize(keyed.mapInArrow(_merge(least, filter_bits if size < LONGEST else 0), _STRIPE), "stripes")
        if size < LONGEST:
            shared.append(spark.sparkContext.broadcast(_filter(merged, filter_bits)))
            words = words or merged.agg(F.sum("total")).first()[0] or 0
            hot = _hot(merged, words)
        levels.append(merged.drop("bits"))
    return levels[0].unionByName(levels[1]).unionByName(levels[2]).unionByName(levels[3])


def _hot(merged: DataFrame, words: int) -> np.ndarray:
    """Hashes of the phrases with over 1/_HOT_SHARE of all words; there are fewer than that."""
    entries = merged.select("lang", "prefix", F.explode(F.arrays_zip("words", "n")).alias("e")).filter(F.col("e.n") * _HOT_SHARE > words)
    rows = entries.select("lang", F.concat_ws(" ", F.nullif("prefix", F.lit("")), "e.words").alias("phrase")).collect()
    return np.array([phrase_hash(r["lang"], [w.encode() for w in r["phrase"].split(" ")]) for r in rows], np.uint64)


def scored(found: DataFrame, least: int, share: int = 80) -> DataFrame:
    """Candidates that no longer one takes over: lang, phrase, a, l, r, score, by the lowest cut."""
    totals = found.filter("prefix <> ''").groupBy("lang", "prefix").agg(F.sum("total").alias("f"))
    totals = materialize(totals.filter(F.col("f") >= least), "phrase-totals")
    entries = found.filter("prefix <> ''").select("lang", "prefix", F.explode(F.arrays_zip("words", "n")).alias("e"))
    phrases = materialize(entries.select("lang", F.concat_ws(" ", "prefix", "e.words").alias("phrase"), F.col("e.n").alias("a")), "candidates")
    words = F.split("phrase", " ")
    each = phrases.withColumn("w", words)
    size = F.size("w")
    # What longer candidates say of the phrases within them; pre-aggregated, hence no hot key.
    within = each.filter(size > 2).select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))).alias("phrase"))
    most = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = phrases.join(most, ["lang", "phrase"], "left").filter(
        f"longer IS NULL OR 100 * cast(longer AS decimal(20,0)) < {share} * cast(a AS decimal(20,0))").drop("longer")
    cut = own.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, size - F.col("k")), " ").alias("rest"))
    count = lambda name, value: totals.select("lang", F.col("prefix").alias(name), F.col("f").alias(value))
    both = cut.join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"])
    points = F.expr("2000000 * cast(a AS decimal(20,0)) div (cast(l AS decimal(20,0)) + r)")
    lowest = both.withColumn("score", points).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b"))
    return lowest.select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")


def ranked(phrases: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language.

    A language is cut down in slices first; what is left is dealt out in order, and the places of a part follow
    from the sizes of the parts before it, so no task holds a whole language.
    """
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    slices = phrases.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = slices.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    parts = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(first.drop("slice", "rank").repartitionByRange(parts, "lang", *order).withColumn("part", F.spark_partition_id()), "in-order")
    sizes = dealt.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("lang", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")).filter(F.col("start") < top)
    own = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    placed = dealt.join(starts, ["lang", "part"]).withColumn("rank", (F.col("start") + own).cast("bigint"))
    return placed.filter(F.col("rank") <= top).drop("part", "start")


def mine(df: DataFrame, least: int = 30, share: int = 80, top: int = 2000, text: str = "text", lang: str = "lang",
         filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to 4 words of each language."""
    found = stripes(df, least, text, lang, filter_bits)
    n = found.filter("prefix = ''").groupBy("lang").agg(F.sum("total").alias("n"))
    best = ranked(scored(found, least, share), top).join(n, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
