"""Exact top-k BM25 search over shards, with dynamic pruning by block maxima.

Statistics (documents, mean length, document frequencies) are taken over the whole corpus, so a
document's score does not depend on its shard. Documents are dealt by hash to shards of about
SHARD_CHARS characters. Every shard is one group of one task: the words of all queries come first, then
its documents, which become an inverted index of those words, then all queries stream past it in
batches, as numbers of words. The shards' top k are merged by score, then id.

A query adds up the lists of its rarer words, whose shares of a score are made once per shard. Frequent words (in
over 1/FREQUENT of the shard) are columns. The documents best by the rarer words, scored in full, give
a threshold. Maxima over blocks of BLOCK documents bound what the frequent words can add, and blocks and documents that cannot
reach the threshold are skipped. Where many are left, the columns are added for many queries in one product in
single precision, and documents further from the k-th than rounding explains are skipped. For what remains
the frequent words are added exactly. A term's share of a score is rounded to 2**-30, so sums are exact in any order and
equal texts tie exactly.

Edge cases: rows without id are left out of corpus and queries; rows of one id are separate
documents; missing and empty texts match nothing and, as queries, give no rows; documents that share no
word with a query are not returned, so a query may have fewer than k rows; other columns are
never read. Ties in score go to the lower id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorspark.plans.shared import materialize

K1, B = 1.2, 0.75
BLOCK = 64
SHARD_CHARS = 32_000_000
UNIT = float(1 << 30)
FREQUENT = 16
_TOGETHER = 64
_WORDS, _DOCUMENT, _QUERY = 0, 1, 2
_RESULT = "query_id long, doc_id long, score double"


def normal(text: Column) -> Column:
    """Lower-case words with one blank between them; the one place where texts are cut into words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _impact(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Share of a word found `tf` times in texts of `length` times the mean."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))


class Shard:
    """Inverted index of some documents; `mean` is the mean length over the whole corpus.

    With a `vocabulary` (numbers by word, below `size`) only its words are indexed; all words count for the length.
    """

    def __init__(self, ids: list[int], texts: Iterable[str], mean: float) -> None:
        self._begin(None, 0)
        for i, text in zip(ids, texts, strict=True):
            self.add(i, text)
        self.finish(mean)

    @classmethod
    def empty(cls, vocabulary: dict[str, int] | None = None, size: int = 0) -> Shard:
        shard = cls.__new__(cls)
        shard._begin(vocabulary, size)
        return shard

    def _begin(self, vocabulary: dict[str, int] | None, size: int) -> None:
        self.open, self.vocabulary, self.size = vocabulary is None, vocabulary or {}, size
        self.ids: np.ndarray | list[int] = []
        self.lengths: list[int] = []
        self.words: list[np.ndarray] = []
        self.scored = 0  # documents scored in full after pruning

    def add(self, doc_id: int, text: str) -> None:
        """One more document; only the numbers of its words are kept."""
        known, cut = self.vocabulary, text.split(" ") if text else []
        if self.open:
            own = np.array([known.setdefault(w, len(known)) for w in cut], np.int32)
        else:
            own = np.fromiter(map(known.get, cut, repeat(-1)), np.int32, len(cut))
            own = own[own >= 0]
        self.ids.append(doc_id)
        self.lengths.append(len(cut))
        self.words.append(own)

    def finish(self, mean: float, idf: np.ndarray | None = None) -> None:
        """`idf` by word: the weights of most words of a query, so what a posting adds at that weight is made once."""
        n = len(self.ids)
        self.size = len(self.vocabulary) if self.open else self.size
        self.ids, self.n = np.array(self.ids, np.int64), n
        sizes = np.fromiter(map(len, self.words), np.int64, n)
        pairs = np.concatenate(self.words).astype(np.int64) if n else np.zeros(0, np.int64)
        del self.words
        pairs *= max(n, 1)
        pairs += np.repeat(np.arange(n, dtype=np.int32), sizes)
        pairs.sort()
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        tf = np.diff(first, append=len(pairs)).astype(np.int32)
        pairs = pairs[first]
        self.term, self.doc = (pairs // max(n, 1)).astype(np.int32), (pairs % max(n, 1)).astype(np.int32)
        del pairs, first
        lengths = np.array(self.lengths, np.int64)
        self.length = np.where(lengths > 0, lengths, 1) / mean
        self.impact = _impact(tf, self.length[self.doc])
        self.start = np.searchsorted(self.term, np.arange(self.size + 1))
        self.idf = np.full(self.size, np.nan) if idf is None else idf
        self.share = None if idf is None else np.rint((idf * UNIT)[self.term] * self.impact)
        # Lists of over 1/FREQUENT of the documents as columns too, and the maxima of their blocks. The last block is filled up.
        held = np.diff(self.start)
        frequent = np.flatnonzero(held * FREQUENT > max(n, FREQUENT))
        self.column = np.full(self.size, -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        at, counts = self._lists(self.start, frequent)
        self.blocks = -(-n // BLOCK)
        self.columns = np.zeros((self.blocks * BLOCK, len(frequent)), np.float32)
        self.times = np.zeros((n, len(frequent)), np.int32)
        place = self.doc[at], np.repeat(np.arange(len(frequent)), counts)
        self.columns[place], self.times[place] = self.impact[at], tf[at]
        self.block_most = self.columns.reshape(self.blocks, BLOCK, -1).max(axis=1) if n else self.columns

    def _lists(self, starts: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the lists `lo`, one after the other, and how long each is."""
        sizes = starts[lo + 1] - starts[lo]
        at = np.arange(sizes.sum()) + np.repeat(starts[lo] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return at, sizes

    def _by_rare(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the words without a column add to each document, in UNITs."""
        rare, own = self.column[t] < 0, w == self.idf[t]
        at, _ = self._lists(self.start, t[rare & own])
        shares = self.share.take(at) if len(at) else np.zeros(0)
        more, sizes = self._lists(self.start, t[rare & ~own])
        if len(more):
            shares = np.concatenate([shares, np.rint(np.repeat(w[rare & ~own] * UNIT, sizes) * self.impact.take(more))])
        return np.bincount(self.doc.take(np.concatenate([at, more])), shares, self.blocks * BLOCK)

    def _full(self, chosen: np.ndarray, t: np.ndarray, w: np.ndarray, partial: np.ndarray) -> np.ndarray:
        """Whole scores of some documents, in UNITs."""
        column = self.column[t]
        times = self.times[chosen[:, None], column[column >= 0]]
        impact = _impact(times, self.length[chosen][:, None])
        return partial[chosen] + np.rint(w[column >= 0] * UNIT * impact).sum(axis=1)

    def _best(self, chosen: np.ndarray, t: np.ndarray, w: np.ndarray, partial: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        score = self._full(chosen, t, w, partial)
        chosen, score = chosen[score > 0], score[score > 0]
        best = np.lexsort((self.ids[chosen], -score))[:k]
        return self.ids[chosen][best], score[best] / UNIT

    def search(self, terms: list[str], weights: Sequence[float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k, best first."""
        t, w = np.array([self.vocabulary.get(x, -1) for x in terms], np.int64), np.asarray(weights, np.float64)
        return self.search_many([(t[t >= 0], w[t >= 0])], k)[0]

    def search_many(self, queries: Sequence[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the best k for each (numbers of words, weights)."""
        asked = np.zeros((self.columns.shape[1], len(queries)), np.float32)
        for i, (t, w) in enumerate(queries):
            column = self.column[t]
            asked[column[column >= 0], i] = w[column >= 0] * UNIT
        # More than rounding can change: relative, of a sum of so many single precision products; absolute, of its rounded terms.
        error, units = (self.columns.shape[1] + 8) * 2.0**-22, self.columns.shape[1]
        more = (self.block_most @ asked).T.astype(np.float64) * (1 + error)
        inside, tried = np.arange(BLOCK), max(k, BLOCK)
        out, left = [], []
        for i, (t, w) in enumerate(queries):
            partial = self._by_rare(t, w)
            blocks = partial.reshape(self.blocks, BLOCK)
            most, threshold = blocks.max(axis=1, initial=0), 0.0
            if self.n > k:  # the k-th best of all is at least that of any, such as those best by the rarer words
                first = np.argpartition(most, self.blocks - tried)[self.blocks - tried:] if self.blocks > tried else np.arange(self.blocks)
                near = (first[:, None] * BLOCK + inside).ravel()
                near = near[near < self.n]
                if len(near) > tried:
                    near = near[np.argpartition(partial[near], len(near) - tried)[len(near) - tried:]]
                if len(near) >= k:
                    threshold = np.partition(self._full(near, t, w, partial), len(near) - k)[len(near) - k]
            bound = most + more[i]
            first = np.flatnonzero((bound > 0) & (bound + units >= threshold))
            bound = blocks[first] + more[i, first][:, None]
            held = (bound > 0) & (bound + units >= threshold)
            if np.count_nonzero(held) * FREQUENT > self.n and self.n > k:
                left.append((i, threshold))
                chosen = first
            else:
                chosen = (first[:, None] * BLOCK + inside)[held]
            out.append((chosen[chosen < self.n], t, w, partial))
        if left:  # many blocks may hold winners: their frequent words are added for all these queries at once
            added = asked[:, [i for i, _ in left]].T @ self.columns.T
            for (i, threshold), sums in zip(left, added, strict=True):
                first, t, w, partial = out[i]
                near = (partial + sums)[:self.n]
                slack = error * float(sums.max()) + units
                threshold = max(threshold, np.partition(near, self.n - k)[self.n - k] - slack)
                out[i] = np.flatnonzero((near > 0) & (near + slack >= threshold)), t, w, partial
        self.scored += sum(len(chosen) for chosen, *_ in out)
        return [self._best(*found, k) for found in out]


def _run(mean: float, k: int, chunks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: int | None = None
        index, vocabulary, idf, state = Shard.empty(), {}, np.zeros(0), _WORDS
        for batch in batches:
            text, ids = batch.column("text"), batch.column("id").to_pylist()
            asked: list[tuple[int, np.ndarray, np.ndarray]] = []
            found: list[tuple[int, np.ndarray, np.ndarray]] = []

            def answer() -> None:
                for at in range(0, len(asked), _TOGETHER):
                    part = asked[at: at + _TOGETHER]
                    best = index.search_many([(t, w) for _, t, w in part], k)
                    found.extend((q, i, s) for (q, _, _), (i, s) in zip(part, best, strict=True))
                asked.clear()

            numbers, n_ends = batch.column("numbers").flatten().to_numpy(), batch.column("numbers").value_lengths().fill_null(0).to_numpy().cumsum()
            terms, t_ends = batch.column("terms").flatten().to_numpy(), batch.column("terms").value_lengths().fill_null(0).to_numpy().cumsum()
            counts = batch.column("counts").flatten().to_numpy()
            for i, (own, kind) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist(), strict=True)):
                if own != shard:
                    answer()
                    shard, vocabulary, idf, state = own, {}, np.zeros(0), _WORDS
                if kind == _WORDS:
                    words = text[i].as_py().split(" ")
                    place = np.arange(len(words)) * chunks + ids[i]
                    if place[-1] >= len(idf):
                        idf = np.concatenate([idf, np.zeros(place[-1] + 1 - len(idf))])
                    vocabulary.update(zip(words, place.tolist(), strict=True))
                    idf[place] = numbers[n_ends[i - 1] if i else 0: n_ends[i]]
                    continue
                if state == _WORDS:
                    index, state = Shard.empty(vocabulary, len(idf)), _DOCUMENT
                if kind == _DOCUMENT:
                    index.add(ids[i], text[i].as_py())
                    continue
                if state == _DOCUMENT:
                    index.finish(mean, idf)
                    state = _QUERY
                t = terms[t_ends[i - 1] if i else 0: t_ends[i]].astype(np.int64)
                asked.append((ids[i], t, counts[t_ends[i - 1] if i else 0: t_ends[i]] * idf[t]))
            answer()
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]), pa.int64()),
                     pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()),
                     pa.array(np.concatenate([s for _, _, s in found]), pa.float64())], ["query_id", "doc_id", "score"])
    return run


def query_words(queries: DataFrame, docs: DataFrame, total: int, chunks: int) -> tuple[DataFrame, DataFrame]:
    """The words of the queries that the corpus has, and the queries by them.

    (chunk, words, idfs): lists of words dealt by hash. (id, terms, counts): a word is numbered by its place in its
    list times `chunks` plus the chunk, so no copy of a query carries words or weights.
    """
    asked = queries.select("id", F.explode(_words(F.col("text"))).alias("w")).groupBy("id", "w").agg(F.count(F.lit(1)).cast("int").alias("qf"))
    wanted = asked.select("w").distinct()
    held = docs.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(float(total)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    known = held.join(wanted, "w", "left_semi").select(F.pmod(F.xxhash64("w"), F.lit(chunks)).alias("chunk"), F.struct("w", idf.alias("idf")).alias("p"))
    lists = known.groupBy("chunk").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    lists = materialize(lists.select("chunk", F.col("ps.w").alias("words"), F.col("ps.idf").alias("idfs")), "query-words")
    numbers = lists.select("chunk", F.posexplode("words").alias("place", "w")).select(
        "w", (F.col("place") * chunks + F.col("chunk")).cast("int").alias("term"))
    pairs = asked.join(numbers, "w").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("term", "qf"))).alias("ps"))
    return lists, pairs.select("id", F.col("ps.term").alias("terms"), F.col("ps.qf").alias("counts"))


def top_k(corpus: DataFrame, queries: DataFrame, k: int = 10, text: str = "text", doc_id: str = "doc_id",
          shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of `corpus` for each row of `queries`."""
    def read(df: DataFrame) -> DataFrame:
        return df.filter(F.col(f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").cast("long").alias("id"), normal(F.col(f"`{text}`")).alias("text"))

    # Stored once: the statistics, the words and the shards all read it.
    docs = read(corpus).withColumns({"n_words": F.size(_words(F.col("text"))), "n_chars": F.length("text")})
    docs, asked = materialize(docs, "normal-texts"), read(queries)
    total, words, chars = docs.agg(F.count(F.lit(1)), F.sum("n_words"), F.sum("n_chars")).first()
    mean, shards = max((words or 0) / max(total, 1), 1e-9), int(max(1, -(-(chars or 0) // shard_chars)))
    lists, numbered = query_words(asked, docs, total, shards)
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    dealt = docs.select(F.pmod(F.xxhash64("id", "text"), F.lit(shards)).cast("int").alias("shard"), F.lit(_DOCUMENT).alias("kind"), "id", "text")
    rows = dealt.unionByName(
        lists.select(everywhere, F.lit(_WORDS).alias("kind"), F.col("chunk").alias("id"), F.array_join("words", " ").alias("text"),
                     F.col("idfs").alias("numbers")), allowMissingColumns=True).unionByName(
        numbered.select(everywhere, F.lit(_QUERY).alias("kind"), "id", "terms", "counts"), allowMissingColumns=True)
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "kind", "id")
    found = rows.mapInArrow(_run(mean, k, shards), _RESULT)
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
