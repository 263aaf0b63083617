import zlib

import numpy as np

from sensorspark.llm import pu_quality as pu


def test_held_out_labels_are_met_and_never_read(spark, folder):
    from sensorspark.llm.queries import QUERIES

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op6_pu_quality"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    right = total = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            total += 1
            right += labels[r.doc_id] == r.predicted
    assert right >= 0.9 * total > 0


def test_newton_finds_the_minimum_of_the_risk(spark):
    rng = np.random.default_rng(0)
    n = 3000
    good = rng.random(n) < 0.7
    x = np.zeros((n, pu.SIZE))
    x[:, 0] = np.where(good, rng.normal(0.7, 0.1, n), rng.normal(0.3, 0.1, n))
    x[:, -1] = 1
    positive = good & (rng.random(n) < 0.4)
    table = spark.createDataFrame([(row.tolist(), bool(p), i % 2 == 0) for i, (row, p) in enumerate(zip(x, positive, strict=True))],
                                  "features array<float>, positive boolean, trial boolean")
    x = x.astype(np.float32).astype(float)
    model = pu.fit(table)
    assert abs(model.prior - good.mean()) < 0.12
    w = np.array(model.weights)

    def risk(v):
        g, loss = x @ v, pu._loss
        p = model.prior
        return p * loss(g[positive]).mean() + max(0, loss(-g).mean() - p * loss(-g[positive]).mean()) + pu.RIDGE / 2 * v @ v
    best = risk(w)
    for _ in range(40):
        step = np.zeros(pu.SIZE)
        step[[0, -1]] = rng.normal(0, 0.3, 2)
        assert risk(w + step) > best - 0.01
    assert ((x @ w > 0) == good).mean() > 0.93


def test_shape_is_bounded():
    for text in ("", " ", "a", "é" * 100, "A!! B!!", "x " * 5000, "\n" * 50 + "word", "#" * 1000, "\x00\x7f"):
        f = pu.shape(text)
        assert f.shape == (pu.SIZE,) and (f >= 0).all() and (f <= 1).all() and f[-1] == 1


def test_awkward_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long")
    assert {r.score for r in pu.score_quality(odd_docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(5,), (8,), (8,), (None,), (999,)], "doc_id long")
    rows = pu.score_quality(odd_docs, some).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert pu.score_quality(no_docs, some).count() == 0
