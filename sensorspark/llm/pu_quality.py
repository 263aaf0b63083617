"""Quality from positive and unlabelled documents, by the non-negative unbiased risk.

Only trusted positives are taken from the labels; every other document, labelled or not, is
unlabelled text. With the class prior pi and the logistic loss l, the fitted risk is

    pi * E_p[l(g)] + max(0, E_u[l(-g)] - pi * E_p[l(-g)])

for a linear g over the shape of a text: shares of 16 byte classes, lengths, repeats. All
shares lie in [0, 1]. The prior is estimated from the whole corpus: of the sets "score at least
t", the least ratio of their unlabelled to their positive mass bounds the positives' share.

Features are written once; each step of the fit is one pass over that narrow table, of which every
task gives back one sum per coefficient pair, added up again before the driver sees a few hundred
numbers. Nothing is sampled.

Edge cases: missing and empty texts have all shares zero and get the score of such a text;
without any positive, or without any document, every score is 0.5. A document with several
label rows is a positive if one of them says so. Ids may be missing (never labelled) or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark.llm.common import documents
from sensorspark.plans.shared import materialize

ROUNDS = 12
RIDGE = 1e-3
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.003)
BINS = 2000
LEAST_MASS = 0.2  # of the positives, in a set that the prior is read from
CERTAINTY = 0.25  # standard-error multiples of a mass

# Class 0 is every byte of a longer character, the last group also takes what no other has.
_GROUPS = (bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b" \t\r\x0b\x0c", b"\n", b".", b",", b"!?",
           b"#", b"*", b"$%", b"&|<>", b":;", b"\"'()[]{}", b"=+-/_~^@\\")
CLASSES = len(_GROUPS) + 1


def _class_of_bytes() -> np.ndarray:
    kinds = np.full(256, len(_GROUPS))
    kinds[128:] = 0
    for i, group in enumerate(_GROUPS):
        kinds[list(group)] = i + 1
    return kinds


_KIND = _class_of_bytes()
SIZE = CLASSES + 9
_SPACE = b" \t\n\x0b\x0c\r"
_NOT_WORDS_OF = {name: bytes(set(range(256)) - set(kept) - set(_SPACE)) for name, kept in (
    ("letter", [*range(65, 91), *range(97, 123), *range(128, 256)]), ("shout", b"!"), ("symbol", b"#*$%&|<>"))}


def shape(text: str) -> np.ndarray:
    """The SIZE features of a text, each in [0, 1]; the last is constant."""
    data = text.encode()
    out = np.zeros(SIZE)
    out[-1] = 1.0
    words = data.split()
    if not words:
        return out
    counts = np.bincount(_KIND, np.bincount(np.frombuffer(data, np.uint8), minlength=256), CLASSES)
    out[:CLASSES] = np.sqrt(counts[:CLASSES] / len(data))
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    out[CLASSES:-1] = (
        min(np.log1p(n) / 16, 1), min(sum(map(len, words)) / n / 32, 1), len(set(words)) / n, 1 - len(set(lines)) / len(lines),
        *(len(data.translate(None, drop).split()) / n for drop in _NOT_WORDS_OF.values()), min(len(lines) / n, 1))
    return out


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _shapes(texts: pa.Array) -> pa.Array:
    rows = np.array([shape(t.as_py() or "") for t in texts], np.float32).reshape(-1, SIZE)
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, SIZE, dtype=np.int32), rows.ravel())


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    prior: float

    def score(self, features: Column) -> Column:
        g = F.aggregate(F.zip_with(features, F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w),
                        F.lit(0.0), lambda a, v: a + v)
        return 1 / (1 + F.exp(-g))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, SIZE)
            yield x, b.column("positive").to_numpy(zero_copy_only=False)


def _summed(table: DataFrame, part, size: int) -> np.ndarray:
    """Sum over the table of what `part(x, positive)` gives for each batch; `size` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for x, positive in _batches(batches):
            total += part(x, positive)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["k", "v"])
    rows = table.select("features", "positive").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["k"]] = r["v"]
    return out


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _curve(table: DataFrame, w: np.ndarray) -> list[np.ndarray]:
    """Sum of features over positives; slope and curvature sums of l(g) over positives, of l(-g) over all documents."""
    def part(x, positive):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        bend = (x * (p * (1 - p))[:, None])
        own = x[positive]
        return np.concatenate([own.sum(axis=0), (p[positive] - 1) @ own, (bend[positive].T @ own).ravel(), p @ x, (bend.T @ x).ravel()])
    d, s = SIZE, _summed(table, part, 3 * SIZE + 2 * SIZE * SIZE)
    ends = np.cumsum([d, d, d * d, d, d * d])[:-1]
    return [v if v.size == d else v.reshape(d, d) for v in np.split(s, ends)]


def _risks(table: DataFrame, tries: list[np.ndarray], prior: float, n_p: float, n_u: float) -> list[float]:
    weights = np.array(tries).T

    def part(x, positive):
        g = x @ weights
        return np.concatenate([_loss(g[positive]).sum(axis=0), _loss(-g[positive]).sum(axis=0), _loss(-g).sum(axis=0)])
    k = len(tries)
    s = _summed(table, part, 3 * k)
    return [prior * s[i] / n_p + max(0.0, s[2 * k + i] / n_u - prior * s[k + i] / n_p) + RIDGE / 2 * float(tries[i] @ tries[i])
            for i in range(k)]


def _fit(table: DataFrame, prior: float, n_p: float, n_u: float, rounds: int) -> np.ndarray:
    """Newton steps of the unbiased risk or, where its negative part counts nothing, of the positives' risk.

    Each round takes the step of either kind, of whatever length, that lowers the non-negative risk most.
    """
    w = np.zeros(SIZE)
    ridge = RIDGE * np.eye(SIZE)
    for _ in range(rounds):
        x_p, slope_p, bend_p, slope, bend = _curve(table, w)
        unbiased = np.linalg.solve(bend / n_u + ridge, slope / n_u - prior * x_p / n_p + RIDGE * w)
        positives = np.linalg.solve(prior * bend_p / n_p + ridge, prior * slope_p / n_p + RIDGE * w)
        tries = [w, *[w - s * step for step in (unbiased, positives) for s in STEPS]]
        risks = _risks(table, tries, prior, n_p, n_u)
        best = int(np.argmin(risks))
        w = tries[best]
        if risks[0] - risks[best] < 1e-6:
            break
    return w


def class_prior(table: DataFrame, w: np.ndarray, n_p: float, n_u: float) -> float:
    """Share of positives among all documents, from the histograms of scores (BINS numbers each)."""
    def part(x, positive):
        at = np.clip(((1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at[positive], minlength=BINS), np.bincount(at, minlength=BINS)])
    s = _summed(table, part, 2 * BINS)
    p, u = (np.cumsum(h[::-1]) for h in (s[:BINS] / n_p, s[BINS:] / n_u))
    # Masses of few documents are uncertain; the bounds of both keep the ratio from falling by chance.
    p, u = p - CERTAINTY / np.sqrt(n_p), u + CERTAINTY / np.sqrt(n_u)
    enough = p >= LEAST_MASS
    return float(np.clip((u[enough] / p[enough]).min() if enough.any() else 1.0, 0.05, 0.99))


def fit(table: DataFrame, rounds: int = ROUNDS) -> Model:
    """Model over (features, positive, trial).

    The prior comes from a first fit that takes half for granted. It learns from the positives
    outside `trial`; the prior is read from how it ranks those inside.
    """
    n_p, n_trial, n_u = table.agg(F.count(F.when(F.col("positive"), 1)), F.count(F.when(F.expr("positive and trial"), 1)),
                                  F.count(F.lit(1))).first()
    if not n_p:
        return Model((0.0,) * SIZE, 0.5)
    prior = 0.99
    if 0 < n_trial < n_p:
        outside, inside = (table.withColumn("positive", F.expr(f"positive and {when}")) for when in ("not trial", "trial"))
        ranking = _fit(outside, 0.5, n_p - n_trial, n_u, rounds)
        prior = class_prior(inside, ranking, n_trial, n_u)
    w = _fit(table, prior, n_p, n_u, rounds)
    return Model(tuple(map(float, w)), prior)


def features(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, features) of every row."""
    return documents(df, text, doc_id).select("doc_id", _shapes("text").alias("features"))


def score_quality(df: DataFrame, positives: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score): a score in [0, 1] for every row, fitted on the ids of trusted `positives` (doc_id)."""
    trusted = positives.select("doc_id").filter("doc_id is not null").distinct().withColumn("positive", F.lit(True))
    rows = materialize(features(df, text, doc_id).join(trusted, "doc_id", "left").select(
        "doc_id", "features", F.coalesce("positive", F.lit(False)).alias("positive"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("trial")), "shapes")
    return rows.select("doc_id", fit(rows).score(F.col("features")).alias("score"))


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by the checksum of their id; their labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
