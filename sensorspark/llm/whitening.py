"""Whitening of embeddings by eigenvectors refined from single to extended precision.

A coordinate c becomes the integer x = floor(64 c) + 1,000,000, so that counts, sums and the
centred products of the covariance are exact whatever the order in which tasks add them up. The
covariance is made by Spark: one pass adds the coordinates, a second one the products of the
coordinates less their rounded mean; what rounding the mean left over is taken off as integers.

The eigenvectors start from a single precision solver and are corrected by Ogita and Aishima's
iteration, which consists of matrix products: first in double, at the end in extended precision.
Eigenvalues that stand closer together than the iteration can tell form a cluster; the space of
a cluster is solved again by itself, shifted by its mean eigenvalue, which gives the small
differences their full relative precision. Vectors within a cluster are as right as extended
precision over their gap allows (1e-16 at a relative gap of 1e-3); the space of a cluster, and orthogonality, do not suffer.

The driver holds matrices of (dimensions x dimensions), whatever the number of rows.

Edge cases. A row takes no part, and is not in the result, when its vector is missing, empty or holds a
missing or non-finite entry, or when its length is not the commonest length of the other rows
(the longer one on a tie). Missing and repeated ids are ids like others; equal vectors give equal
rows. Other columns are not read. 64 c beyond +-2**45 counts as that bound. Components whose
eigenvalue is zero to double precision (one row, equal rows, dependent dimensions) cannot be scaled: their
`whitened` is NULL and they are left out of the identity error, which is NULL when no component is
left. An empty table, or one without usable rows, gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import finite_vectors
from sensorspark.plans.shared import materialize

SCALE, OFFSET = 64, 1_000_000
_BOUND = float(1 << 45)
# Products of two limbs, added over a block of rows, stay below 2**53 and are exact in doubles.
_LIMB_BITS, _BLOCK = 22, 512
_STEPS = 12
_EXACT = pa.decimal128(38, 0)


def integers(vectors: np.ndarray) -> np.ndarray:
    """The integers x of coordinates, as doubles."""
    return np.floor(np.clip(vectors * SCALE, -_BOUND, _BOUND)) + OFFSET


def exact_products(rows: np.ndarray) -> np.ndarray:
    """rows' rows for integer-valued doubles below 2**47, as Python integers."""
    total = np.zeros((rows.shape[1],) * 2, object)
    for start in range(0, len(rows), _BLOCK):
        rest, limbs = rows[start:start + _BLOCK], []
        while rest.any():
            high = np.trunc(rest / (1 << _LIMB_BITS))
            limbs.append(rest - high * (1 << _LIMB_BITS))
            rest = high
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << _LIMB_BITS * (i + j)
    return total


def _matrix(batch: pa.RecordBatch, column: int = 1) -> tuple[pa.Array, np.ndarray]:
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return lists, flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _decimals(numbers: Iterable[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], _EXACT)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: row count (dim -1) and sum of each dimension over the rows of a task."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        lists = batch.column(1)
        lengths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        for size in np.unique(lengths).tolist():
            at = starts[:-1][lengths == size]
            x = integers(flat[at[:, None] + np.arange(size)]).astype(np.int64)
            here = np.concatenate([[len(at)], x.sum(axis=0)]).astype(object)
            found[size] = found[size] + here if size in found else here
    for size, sums in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * len(sums), pa.int32()), pa.array(range(-1, size), pa.int32()), _decimals(sums)], ["size", "dim", "s"])


def _pairs(dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(dims)


def _symmetric(dims: int, rows: list, kind: type) -> np.ndarray:
    out = np.zeros((dims, dims), kind)
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["g"]
    return out


def _centred_products(centre: np.ndarray):
    """Exact products of integer coordinates less `centre`, upper triangle, one partial sum per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + exact_products(integers(_matrix(batch)[1]) - centre)
        if isinstance(total, np.ndarray):
            i, j = _pairs(len(centre))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total[i, j])], ["i", "j", "g"])
    return run


def covariance(products: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """(products - sums sums' / n) / n from integers, correctly rounded to the sum of two doubles, in extended precision."""
    dims = len(sums)
    out = np.zeros((dims, dims), np.longdouble)
    square = n * n
    for i in range(dims):
        for j in range(i, dims):
            top = n * int(products[i, j]) - sums[i] * sums[j]
            high = top / square
            p, q = high.as_integer_ratio()
            out[i, j] = out[j, i] = np.longdouble(high) + np.longdouble((top * q - p * square) / (q * square))
    return out


def _refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One correction: better vectors, eigenvalues, the distance below which these cannot be told apart, size of the step."""
    one = np.eye(len(a), dtype=a.dtype)
    off = one - x.T @ x
    s = x.T @ (a @ x)
    off, s = (off + off.T) / 2, (s + s.T) / 2  # only then do the steps of close pairs keep the vectors orthogonal
    values = np.diag(s) / (1 - np.diag(off))
    near = 2 * (np.linalg.norm((s - np.diag(values)).astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(off.astype(float)))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    step = np.where(apart, (s + values[None, :] * off) / np.where(apart, gap, 1), off / 2)
    return x + x @ step, values, float(near), float(np.abs(step).max())


def _split_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, near: float) -> np.ndarray:
    """Solve the space of every cluster of eigenvalues by itself, around the cluster's mean."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    for group in np.split(order, cuts):
        if len(group) > 1:
            inside = x[:, group]
            shifted = a @ inside - inside * values[group].mean()
            small = (inside.T @ shifted).astype(float)
            size = np.abs(small).max()
            if size > 0:
                x[:, group] = inside @ np.linalg.eigh((small + small.T) / (2 * size))[1].astype(x.dtype)
    return x


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, right to double precision."""
    size = np.abs(v).max() if v.size else 0
    if not size > 0:
        return np.zeros(len(v)), np.eye(len(v))
    a = (v / size).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1]
    for kind in (np.float64, np.longdouble):
        at, x, last = a.astype(kind), x.astype(kind), np.inf
        for _ in range(_STEPS):
            x, values, near, step = _refine(at, x)
            if step < 8 * len(a) * np.finfo(kind).eps or step > last / 2 and step < 1e-6:
                break  # right, or as right as this precision can tell close pairs apart
            x, last = _split_clusters(at, x, values, near), step
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * size).astype(float), x[:, order].astype(float)


@dataclass(frozen=True)
class Whitener:
    """What a fit found. `centre` is the rounded mean, `rest` the exact sums of x less it; vectors are columns."""

    n: int
    centre: np.ndarray
    rest: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        return self.values > len(self.centre) * np.finfo(float).eps * self.values.max(initial=0.0)


def fit(rows: DataFrame) -> Whitener | None:
    """Whitener of rows (id, vector); None if there are none."""
    sums = materialize(rows.mapInArrow(_sums, "size int, dim int, s decimal(38,0)").groupBy("size", "dim").agg(F.sum("s").alias("s")), "sums")
    common = sums.filter("dim = -1").orderBy(F.desc("s"), F.desc("size")).first()
    if common is None:
        return None
    n, dims = int(common["s"]), common["size"]
    found = {r["dim"]: int(r["s"]) for r in sums.filter((F.col("size") == dims) & (F.col("dim") >= 0)).collect()}
    total = [found[d] for d in range(dims)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = tuple(s - n * c for s, c in zip(total, centre, strict=True))
    middle = np.array(centre, float)
    parts = rows.filter(F.size("vector") == dims).mapInArrow(_centred_products(middle), "i int, j int, g decimal(38,0)")
    products = _symmetric(dims, parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect(), object)
    v = covariance(products, rest, n)
    values, columns = eigenvectors(v)
    return Whitener(n, middle, rest, values, columns, float(np.trace(v)))


def _whitened(w: Whitener, components: int):
    scale = np.where(w.usable, w.values, np.inf)[:components]
    turn = w.vectors[:, :components] / np.sqrt(scale)
    mean_rest = np.array([r / w.n for r in w.rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = integers(_matrix(batch)[1]) - w.centre
            if np.abs(d).max(initial=0) * w.n < float(1 << 30) / np.sqrt(max(1, len(w.centre))):
                far = d.astype(np.int64) * w.n - np.array(w.rest, np.int64)
                spread = pa.array((far * far).sum(axis=1), pa.int64()).cast(_EXACT)
            else:
                far = d.astype(np.int64).astype(object) * w.n - np.array(w.rest, object)
                spread = _decimals((far * far).sum(axis=1))
            y = (d - mean_rest) @ turn
            flat = pa.array(y.ravel(), mask=np.tile(~w.usable[:components], len(y)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), spread, lists], ["id", "deviation", "whitened"])
    return run


def _about(middle: np.ndarray):
    """Products of whitened coordinates less their means, upper triangle, one partial sum per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(middle),) * 2)
        for batch in batches:
            if batch.num_rows:
                y = np.nan_to_num(_matrix(batch, 0)[1]) - middle
                total += y.T @ y
        i, j = _pairs(len(middle))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "g"])
    return run


def identity_error(rows: DataFrame, usable: np.ndarray, n: int) -> float | None:
    """Largest absolute entry of the covariance of `whitened` over all rows, less the identity."""
    k = len(usable)
    if not usable.any():
        return None
    means = rows.select([F.avg(F.get("whitened", F.lit(c))).alias(str(c)) for c in range(k)]).first()
    middle = np.array([m or 0.0 for m in means])
    parts = rows.select("whitened").mapInArrow(_about(middle), "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    found = _symmetric(k, parts.collect(), float) / n - np.eye(k)
    return float(np.abs(found[np.ix_(usable, usable)]).max())


def whiten(df: DataFrame, components: int = 32, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """One row per usable row and component: id, component (from 1), n, deviation (decimal), whitened, explained, identity_error.

    `deviation` is the exact sum of (n x - S)^2 over the dimensions, S being the sums of x; `explained`
    is the share of the component's eigenvalue in the trace.
    """
    rows = finite_vectors(df, vector, id)
    w = fit(rows)
    names = ("component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    if w is None:
        kind = rows.schema["id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"`{id}` {kind}, {names}")
    k = min(components, len(w.centre))
    same_length = rows.filter(F.size("vector") == len(w.centre))
    kind = rows.schema["id"].dataType.simpleString()
    stored = materialize(same_length.mapInArrow(
        _whitened(w, k), f"id {kind}, deviation decimal(38,0), whitened array<double>"), "whitened")
    error = identity_error(stored, w.usable[:k], w.n)
    shares = F.array(*[F.lit(float(e / w.trace) if w.trace > 0 else None).cast("double") for e in w.values[:k]]) if k else F.array()
    return stored.select(
        F.col("id").alias(id), F.lit(w.n).cast("bigint").alias("n"), "deviation", F.posexplode("whitened").alias("_p", "whitened")).select(
        id, (F.col("_p") + 1).alias("component"), "n", "deviation", "whitened", F.get(shares, F.col("_p")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
