"""Quality rules as a bitmask ledger.

Every rule is evaluated once. A document's ledger entry holds its measurements and one bit
per failed rule; policies are masks over those bits, so a new policy version, or the question
what a rule costs, never reads a text again.

Edge cases: a missing text counts as empty (it fails `few_words`); ids may be missing or
repeated, each row is judged by itself; other columns of the input are never read. Lines of a
text end at "\\n" only. Nothing is shuffled but the counts of `ablate`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark.llm.common import documents

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_shout_words", "n_letters", "n_upper")

_SPACE = b" \t\n\x0b\x0c\r"
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def _all_but(kept: bytes) -> bytes:
    return bytes(set(range(256)) - set(kept))


_NOT_LETTER = _all_but(_LETTERS + _SPACE)
_NOT_SHOUT = _all_but(b"!" + _SPACE)
_NOT_UPPER = _all_but(bytes(range(65, 91)))
_NOT_ASCII_LETTER = _all_but(bytes([*range(65, 91), *range(97, 123)]))
_NOT_SYMBOL = _all_but(SYMBOLS)


def repeated_words(words: Sequence[bytes]) -> int:
    """Words that lie in a window of WINDOW words which occurs at least twice in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    word = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    # Windows of two, four, then five words, each numbered densely so that keys stay exact.
    two = np.unique(word[:-1] * len(known) + word[1:], return_inverse=True)[1]
    if two.max() + 1 == n - 1:
        return 0
    four = np.unique(two[:-2] * (two.max() + 1) + two[2:], return_inverse=True)[1]
    _, five, times = np.unique(four[:-1] * len(known) + word[4:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[five] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[at] += 1
    edges[at + WINDOW] -= 1
    return int((np.cumsum(edges[:n]) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The MEASURES of one text."""
    data = text.encode()
    words = data.split()  # bytes.split() knows exactly the six separators
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words), len(text) - sum(map(data.count, (bytes([c]) for c in _SPACE))),
        len(data.translate(None, _NOT_SYMBOL)), len(lines) - len(set(lines)), repeated_words(words), len(lines),
        len(data.translate(None, _NOT_LETTER).split()), len(data.translate(None, _NOT_SHOUT).split()),
        len(data.translate(None, _NOT_ASCII_LETTER)), len(data.translate(None, _NOT_UPPER)),
    )


_TYPE = pa.struct([(name, pa.int64()) for name in MEASURES])


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measures(texts: pa.Array) -> pa.Array:
    rows = [measure(t.as_py() or "") for t in texts]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in MEASURES]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_TYPE))


def rules(m: Column) -> dict[str, Column]:
    """Rules in the order of their bits; true means failed. New rules go to the end. Integer arithmetic only."""
    words = m["n_words"]
    return {
        "few_words": words < 10,
        "repeated_windows": 100 * m["n_repeat_words"] > 20 * words,
        "symbols": 10 * m["n_symbols"] > words,
        "word_length": (m["word_chars"] < 2 * words) | (m["word_chars"] > 15 * words),
        "duplicate_lines": 100 * m["n_dup_lines"] > 30 * m["n_lines"],
        "letterless_words": 100 * m["n_letter_words"] < 80 * words,
        "shouting_marks": 100 * m["n_shout_words"] > 30 * words,
        "upper_case": 100 * m["n_upper"] > 60 * m["n_letters"],
    }


RULES = ("few_words", "repeated_windows", "symbols", "word_length", "duplicate_lines", "letterless_words",
         "shouting_marks", "upper_case")
BASE = ("few_words", "repeated_windows")


def mask(names: Sequence[str]) -> int:
    return sum(1 << RULES.index(name) for name in set(names))


@dataclass(frozen=True)
class Policy:
    """Failing any of `hard`, or more than `allowed` of `soft`, rejects a document."""

    version: str
    hard: tuple[str, ...] = ()
    soft: tuple[str, ...] = ()
    allowed: int = 0

    def rejects(self, bits: Column) -> Column:
        soft = F.bit_count(bits.bitwiseAND(F.lit(mask(self.soft)).cast("bigint")))
        return (bits.bitwiseAND(F.lit(mask(self.hard)).cast("bigint")) != 0) | (soft > self.allowed)


POLICIES = {p.version: p for p in (
    Policy("base", hard=BASE),
    Policy("v1", hard=(*BASE, "symbols", "letterless_words")),
    Policy("v2", hard=(*BASE, "symbols", "letterless_words", "shouting_marks"),
           soft=("word_length", "duplicate_lines", "upper_case"), allowed=1),
)}


def with_ledger(df: DataFrame, text: str = "text", column: str = "ledger") -> DataFrame:
    """The input with one more column: struct of the measurements and `fail_bits`."""
    measured = df.withColumn(column, _measures(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    m = F.col(f"`{column}`")
    bits = sum((failed.cast("bigint") * F.lit(1 << i) for i, failed in enumerate(rules(m).values())),
               F.lit(0).cast("bigint"))
    return measured.withColumn(column, F.struct(*[m[name].alias(name) for name in MEASURES], bits.alias("fail_bits")))


def ledger(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, measurements, fail_bits): one row per document."""
    return with_ledger(documents(df, text, doc_id)).select("doc_id", "ledger.*")


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """`base_failed` and `kept` for ledger entries."""
    bits = F.col("fail_bits")
    base = POLICIES["base"].rejects(bits)
    return entries.withColumns({"base_failed": base, "kept": ~(base | policy.rejects(bits))})


def ablate(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule: documents that fail it, fail it alone, and would be kept by the policy without it.

    Entries are first counted by their bits, at most 2 ** len(RULES) groups whatever the input.
    """
    counted = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    every = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
                                for i, r in enumerate(RULES)])).alias("r")
    bits, bit = F.col("fail_bits"), F.col("bit")
    fails = bits.bitwiseAND(bit) != 0
    freed = policy.rejects(bits) & ~policy.rejects(bits.bitwiseAND(F.bitwise_not(bit)))
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return counted.select("fail_bits", "n", every).select("fail_bits", "n", "r.*").groupBy("rule").agg(
        count(fails)("failed"), count(bits == bit)("failed_alone"), count(freed)("freed"))


def keep_documents(df: DataFrame, policy: Policy, text: str = "text") -> DataFrame:
    """The rows of the input that the policy keeps, all columns as they came."""
    name = "_ledger"
    while name in df.columns:
        name += "_"
    bits = F.col(f"`{name}`.fail_bits")
    rejected = POLICIES["base"].rejects(bits) | policy.rejects(bits)
    return with_ledger(df, text, name).filter(~rejected).drop(name)
