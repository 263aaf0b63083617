"""Exact quantiles of many columns without holding a column in one task.

Mergeable KLL sketches bracket the wanted order statistics of all columns in the pass that also
counts them; a second pass counts what lies below and inside every bracket; a third one reads the
few values inside, so three passes are enough while the brackets hold at most READABLE_ROWS values. Larger
ones are bracketed again, inside only. A bracket that misses its ranks, which a sketch may do, is thrown
away and the one before it halved. Nothing but brackets and at most READABLE_ROWS counted values
reach the driver. NULL, NaN and infinities are no values.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.functions.numeric import finite

READABLE_ROWS = 20_000
# Size of a sketch and the rank error, as a share of the rows, that its brackets allow for.
SKETCH_SIZE, RANK_ERROR = 2048, 0.003
RANGES_PER_PASS = 128
# Sketches are kept by column in a hash table, which Spark gives up for a sort from 128 keys on.
COLUMNS_PER_PASS = 100


@dataclass
class _Range:
    """The order statistics `first` and `last` (from 0) of a column: both in [low, high], which holds `rows` values after `below`."""

    column: str
    first: int
    last: int
    low: float
    high: float
    below: int
    rows: int
    found: tuple[float, float] | None = None

    def bracket(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high


def _by_column(df: DataFrame, values: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """(c, v): the values of each column under its place in `columns`. Plans stay small however many columns there are."""
    return df.select(F.posexplode(F.array(*[values[c] for c in columns])).alias("c", "v")).filter("v IS NOT NULL")


def _brackets(wanted: Iterable[tuple[str, float, float]]) -> tuple[dict[str, list[tuple[float, float]]], list[tuple[Column, Column]]]:
    """Different brackets of each column, and the k-th (low, high) of the column that a row of `_by_column` belongs to."""
    by_column: dict[str, list[tuple[float, float]]] = {}
    for c, *bracket in dict.fromkeys(wanted):
        by_column.setdefault(c, []).append(tuple(bracket))

    def end(k: int, side: int) -> Column:
        # Columns with fewer brackets have NaN, which holds nothing.
        return F.element_at(F.lit(np.array([b[k][side] if k < len(b) else math.nan for b in by_column.values()], np.float64)), F.col("c") + 1)
    return by_column, [(end(k, 0), end(k, 1)) for k in range(max(map(len, by_column.values()), default=0))]


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))


def _read_at(sketch: Column, shares: Sequence[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(min(1.0, max(0.0, s)))) for s in shares]))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], exact: bool = True,
              accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column; None for a column without values."""
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    if not columns:
        return {}
    values = {c: finite(F.col(f"`{c}`").cast("double")) for c in columns}
    if not exact:
        wanted = F.array(*[F.lit(p) for p in probabilities])
        row = df.agg(*[F.percentile_approx(v, wanted, F.lit(accuracy)) for v in values.values()]).first()
        return {c: list(row[i]) if row[i] is not None else [None] * len(probabilities) for i, c in enumerate(columns)}
    shares = [p + sign * RANK_ERROR for p in probabilities for sign in (-1, 1)]
    known: dict[str, list] = {}
    for at in range(0, len(columns), COLUMNS_PER_PASS):
        part = columns[at: at + COLUMNS_PER_PASS]
        summed = _by_column(df, values, part).groupBy("c").agg(
            F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), _sketch(F.col("v")).alias("sketch"))
        for row in summed.select("c", "n", "low", "high", _read_at(F.col("sketch"), shares)).collect():
            known[part[row[0]]] = list(row[1:])
    ranges: dict[tuple[str, int], _Range] = {}
    tries = []
    for c in columns:
        n, low, high, brackets = known.get(c, (0, None, None, None))
        for k, p in enumerate(probabilities if n else []):
            place = p * (n - 1)
            ranges[c, k] = _Range(c, math.floor(place), math.ceil(place), low, high, 0, n)
            # Few rows: the neighbours of a rank lie further off, as shares, than the error that is allowed for.
            few = n * RANK_ERROR < 3
            tries.append((ranges[c, k], *((low, high) if few else brackets[2 * k: 2 * k + 2])))
    _count(df, values, tries, first=True)
    while open_ranges := [r for r in ranges.values() if r.found is None]:
        if sum({r.bracket(): r.rows for r in open_ranges}.values()) <= READABLE_ROWS:
            _read(df, values, open_ranges)
        else:
            for at in range(0, len(open_ranges), RANGES_PER_PASS):
                _narrow(df, values, open_ranges[at: at + RANGES_PER_PASS])

    def between(r: _Range, p: float) -> float:
        place = p * (known[r.column][0] - 1)
        return r.found[0] + (r.found[1] - r.found[0]) * (place - math.floor(place))
    return {c: [between(ranges[c, k], p) if (c, k) in ranges else None for k, p in enumerate(probabilities)] for c in columns}


def _narrow(df: DataFrame, values: dict[str, Column], ranges: Sequence[_Range]) -> None:
    """Sketch the inside of every bracket, then count the new ones."""
    inside = {r.bracket(): F.when(values[r.column].between(F.lit(r.low), F.lit(r.high)), values[r.column]) for r in ranges}
    names = {b: f"s{i}" for i, b in enumerate(inside)}
    summed = df.agg(*[_sketch(v).alias(names[b]) for b, v in inside.items()])

    def near(r: _Range) -> list[float]:
        slack = RANK_ERROR + 2 / r.rows
        return [(r.first - r.below) / r.rows - slack, (r.last - r.below + 1) / r.rows + slack]

    row = summed.select(*[_read_at(F.col(names[r.bracket()]), near(r)) for r in ranges]).first()
    _count(df, values, [(r, low, high) for r, (low, high) in zip(ranges, row, strict=True)])


def _count(df: DataFrame, values: dict[str, Column], tries: Sequence[tuple[_Range, float, float]], first: bool = False) -> None:
    """Take over the brackets that hold their ranks; halve the others, and those that are no smaller unless it is the first time."""
    halved = []
    wanted, tests = _brackets((r.column, low, high) for r, low, high in tries)
    counted = _by_column(df, values, list(wanted)).groupBy("c").agg(*[
        F.count_if(test) for low, high in tests for test in (F.col("v") < low, F.col("v").between(low, high))])
    known = {}
    for row in counted.collect() if wanted else ():
        c = list(wanted)[row[0]]
        known.update({(c, *b): (row[1 + 2 * k], row[2 + 2 * k]) for k, b in enumerate(wanted[c])})
    for r, low, high in tries:
        below, rows = known[r.column, low, high]
        holds = below <= r.first and r.last < below + rows
        if holds and (first or rows < r.rows or low == high):
            r.low, r.high, r.below, r.rows = low, high, below, rows
            if low == high:
                r.found = (low, low)
        else:
            halved.append(r)
    if halved:
        _halve(df, values, halved)


def _halve(df: DataFrame, values: dict[str, Column], ranges: Sequence[_Range]) -> None:
    """Cut brackets in the middle of their values' range; always makes progress."""
    cuts = []
    for r in ranges:
        middle = r.low + (r.high - r.low) / 2
        cuts.append(middle if r.low <= middle < r.high else r.low)
    rows = df.agg(*[a for r, cut in zip(ranges, cuts, strict=True) for v in (values[r.column],) for a in (
        F.count_if(v.between(F.lit(r.low), F.lit(cut))), F.max(F.when(v.between(F.lit(r.low), F.lit(cut)), v)),
        F.min(F.when((v > cut) & (v <= r.high), v)))]).first()
    for i, r in enumerate(ranges):
        under, top, bottom = rows[3 * i: 3 * i + 3]
        if r.last < r.below + under:
            r.high, r.rows = top, under
        elif r.first >= r.below + under:
            r.low, r.below, r.rows = bottom, r.below + under, r.rows - under
        else:  # the two neighbours lie on either side of the cut
            r.found = (top, bottom)
        if r.low == r.high:
            r.found = (r.low, r.low)


def _read(df: DataFrame, values: dict[str, Column], ranges: Sequence[_Range]) -> None:
    """Count the values inside the last brackets, at most READABLE_ROWS in all."""
    wanted, tests = _brackets(r.bracket() for r in ranges)
    inside = F.array_compact(F.array(*[F.when(F.col("v").between(low, high), F.lit(k)) for k, (low, high) in enumerate(tests)]))
    found = _by_column(df, values, list(wanted)).select("c", "v", F.explode(inside).alias("k"))
    counted: dict[tuple[str, float, float], list] = {}
    for row in found.groupBy("c", "k", "v").agg(F.count(F.lit(1)).alias("n")).collect():
        c = list(wanted)[row["c"]]
        counted.setdefault((c, *wanted[c][row["k"]]), []).append((row["v"], row["n"]))
    for r in ranges:
        ends, seen = [], r.below
        for value, n in sorted(counted[r.bracket()]):
            seen += n
            ends += [value] * ((r.first < seen) + (r.last < seen) - len(ends))
        r.found = (ends[0], ends[1])
