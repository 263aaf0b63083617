import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from sensorspark.llm import queries
from sensorspark.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, n string, whitened string"


def table(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", None)
                                  for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def check(rows, kept, components):
    """Against exact integers and a double precision solver."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept]
    n, dims = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x, strict=True)]
    far = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    v = np.array([[float(Fraction(sum(f[i] * f[j] for f in far), n ** 3)) for j in range(dims)] for i in range(dims)])
    values = np.linalg.eigvalsh(v)[::-1]
    got = defaultdict(dict)
    for r in rows:
        got[r.vec_id][r.component] = r
    assert set(got) == {i for i, _ in kept} and all(set(g) == set(range(1, min(components, dims) + 1)) for g in got.values())
    for (i, _), f in zip(kept, far, strict=True):
        assert {(r.n, int(r.deviation)) for r in got[i].values()} == {(n, sum(c * c for c in f))}
    y = np.array([[got[i][c + 1].whitened for c in range(min(components, dims))] for i, _ in kept], float)
    centred = np.array([[c / n for c in f] for f in far])
    for c in range(y.shape[1]):
        share = got[kept[0][0]][c + 1].explained
        assert share == pytest.approx(values[c] / values.sum(), rel=1e-9, abs=1e-14)
        if not np.isnan(y[0, c]):
            assert y[:, c] @ y[:, c] / n == pytest.approx(1, abs=1e-9)
            back = centred.T @ y[:, c] / n  # the eigenvector times the root of its eigenvalue
            assert np.allclose(v @ back, values[c] * back, atol=1e-9 * values[0] * np.sqrt(values[0]))
    return y


def test_equals_exact_covariance(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).astype(np.float32).tolist()
    odd = [None, [], [1.0] * 5 + [None], [1.0] * 5 + [float("nan")], [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    df = table(spark, vectors + odd)
    rows = w.whiten(df, 4).collect()
    y = check(rows, list(enumerate(vectors)), 4)
    assert {r.identity_error for r in rows}.pop() < 1e-9 and np.abs(np.cov(y.T, bias=True) - np.eye(4)).max() < 1e-9
    assert all(r.deviation is not None for r in rows)


def test_repeated_and_missing_ids_and_equal_vectors(spark):
    vectors = [[1, 2], [1, 2], [3, -1], [0, 5], [2, 2]]
    rows = w.whiten(table(spark, vectors, [7, 7, None, None, 1])).collect()
    assert len(rows) == 10 and {r.n for r in rows} == {5}
    assert len({r.whitened for r in rows if r.vec_id == 7 and r.component == 1}) == 1


@pytest.mark.parametrize("vectors", [[[1, 2, 3]], [[1, 2, 3]] * 4, [[i, 2 * i, 0] for i in range(9)]])
def test_components_without_spread(spark, vectors):
    rows = w.whiten(table(spark, vectors)).collect()
    assert len(rows) == 3 * len(vectors)
    flat = {c for c in (1, 2, 3) if all(r.whitened is None for r in rows if r.component == c)}
    assert flat == ({1, 2, 3} if len({tuple(v) for v in vectors}) == 1 else {2, 3})
    assert all((r.identity_error is None) == (flat == {1, 2, 3}) for r in rows)


def test_empty_and_unusable_tables(spark):
    for vectors in ([], [None, [None], []]):
        found = w.whiten(table(spark, vectors))
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and not found.collect()


def test_huge_coordinates_stay_exact(spark):
    vectors = [[1e30, 0.5], [-1e30, 0.25], [3e9, 1.0]]
    rows = w.whiten(table(spark, vectors)).collect()
    x = [[int(min(max(np.floor(64 * np.float32(c)), -2 ** 45), 2 ** 45)) + 1_000_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    assert {(r.vec_id, int(r.deviation)) for r in rows} == set(enumerate(want))


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 24), np.r_[np.full(4, 3.0), np.full(4, 3.0 + 1e-9), np.linspace(1, 2, 16)],
    np.r_[np.ones(8) * 1e-3, np.ones(16)], np.r_[5.0, np.zeros(23)]])
def test_clusters_are_resolved(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q @ (np.eye(24) * 1.5 - q.T @ q / 2)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = w.eigenvectors(a)
    assert np.abs(np.sort(values)[::-1] - found).max() < 1e-14 * values.max()
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-14
    for near in values:  # eigenspaces, whatever the basis within; close pairs as far as extended precision over the gap goes
        for width, limit in ((1e-6, 1e-13), (1e-12, 1e-8)):
            own, of = np.abs(values - near) < width, np.abs(found - near) < width
            assert own.sum() == of.sum()
            assert np.abs((q[:, own] @ q[:, own].T).astype(float) - x[:, of] @ x[:, of].T).max() < limit


def test_products_are_exact():
    rng = np.random.default_rng(2)
    d = rng.integers(-(1 << 46), 1 << 46, size=(700, 3))
    big = [[sum(int(a) * int(b) for a, b in zip(d[:, i], d[:, j], strict=True)) for j in range(3)] for i in range(3)]
    assert w.exact_products(d.astype(float)).tolist() == big


def test_query_covers_the_table(spark, folder):
    rows = queries.op11(spark, folder).collect()
    vectors = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(rows, vectors, 32)
    assert max(r.identity_error for r in rows) < 1e-4
