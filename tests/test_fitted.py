import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sensorspark.operators import quantiles as Q
from sensorspark.operators.fitted import MedianImputer, QuantileClipper, TargetTransformer, TargetTransformerModel, cap_outliers

PROBABILITIES = [0.0, 0.005, 0.25, 0.5, 0.77, 0.995, 1.0]


def table(spark, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "spread": np.exp(rng.normal(0, 6, n)), "ties": rng.integers(0, 3, n).astype(float), "flat": 7.0,
        "hot": np.where(rng.random(n) < 0.4, 0.0, rng.normal(0, 1e5, n)), "gaps": np.where(rng.random(n) < 0.9, np.nan, rng.random(n))})
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns)).repartition(4)


@pytest.mark.parametrize(("readable", "size", "error"), [(0, 8, 0.0), (50, 8, 0.1), (0, 200, 0.02), (100_000, 2048, 0.003)])
def test_quantiles_are_exact(spark, monkeypatch, readable, size, error):
    """Also with sketches so coarse that brackets miss their ranks."""
    pdf, df = table(spark)
    monkeypatch.setattr(Q, "READABLE_ROWS", readable)
    monkeypatch.setattr(Q, "SKETCH_SIZE", size)
    monkeypatch.setattr(Q, "RANK_ERROR", error)
    got = Q.quantiles(df, list(pdf.columns), PROBABILITIES)
    for c in pdf.columns:
        np.testing.assert_allclose(got[c], pdf[c].dropna().quantile(PROBABILITIES).tolist(), rtol=1e-12)


def test_three_passes_are_enough(spark, monkeypatch):
    passes = []
    for name in ("_count", "_read", "_narrow", "_halve"):
        real = getattr(Q, name)
        monkeypatch.setattr(Q, name, lambda *a, real=real, name=name, **k: passes.append(name) or real(*a, **k))
    pdf, df = table(spark, 60_000)
    got = Q.quantiles(df, list(pdf.columns), [0.005, 0.5, 0.995])
    assert passes == ["_count", "_read"], "one pass for sketches and ends comes before"
    for c in pdf.columns:
        np.testing.assert_allclose(got[c], pdf[c].dropna().quantile([0.005, 0.5, 0.995]).tolist(), rtol=1e-12)


@pytest.mark.parametrize("readable", [0, 10, 100_000])
def test_values_that_are_not_finite_do_not_count(spark, monkeypatch, readable):
    monkeypatch.setattr(Q, "READABLE_ROWS", readable)
    odd = [float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in [*map(float, range(101)), *odd]], "x double")
    assert Q.quantiles(df, ["x"], [0.0, 0.5, 1.0]) == {"x": [0.0, 50.0, 100.0]}
    wide = spark.createDataFrame([(v,) for v in (-1.7e308, -1e-300, 0.0, 5e-324, 1.7e308)], "x double")
    assert Q.quantiles(wide, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0]) == {"x": [-1.7e308, -1e-300, 0.0, 5e-324, 1.7e308]}


def test_plans_do_not_grow_with_the_columns(spark, monkeypatch):
    """One sketch for all columns of a pass; the last column has no values."""
    built = []
    real = Q._sketch
    monkeypatch.setattr(Q, "_sketch", lambda v: built.append(1) or real(v))
    df = spark.range(101).select(*[(F.col("id") * (i + 1)).cast("double").alias(f"x.{i}") for i in range(120)], F.lit(None).cast("double").alias("none"))
    got = Q.quantiles(df, df.columns, [0.25, 0.5])
    assert len(built) == 2
    assert got == {**{f"x.{i}": [25.0 * (i + 1), 50.0 * (i + 1)] for i in range(120)}, "none": [None, None]}


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert Q.quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [2.0]}
    assert Q.quantiles(df, [], [0.5]) == {}
    assert Q.quantiles(df, ["b"], [0.5], exact=False)["b"][0] in (1.0, 3.0)


def test_bounds_come_from_the_training_rows(spark):
    train = spark.range(101).select(F.col("id").cast("double").alias("x"))
    model = QuantileClipper(inputCols=["x"], lowerQuantile=0.1, upperQuantile=0.9).fit(train)
    other = spark.createDataFrame([(-5.0,), (50.0,), (1000.0,), (None,)], "x double")
    assert [r["x"] for r in model.transform(other).collect()] == [10.0, 50.0, 90.0, None]


def test_imputer_marks_only_columns_with_training_gaps(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, None), (10.0, 7.0)], "a double, b double")
    model = MedianImputer(inputCols=["a", "b"]).fit(train)
    out = model.transform(spark.createDataFrame([(None, None)], "a double, b double"))
    assert out.columns == ["a", "b", "missingindicator_b"] == model.output_columns() and out.first()[:] == (3.0, 6.0, 1.0)


def test_inverse_of_the_target_transform_is_the_clip(spark):
    y = spark.createDataFrame([(-3.0,), (0.0,), (12.5,), (400.0,), (None,)], "t double")
    model = TargetTransformer(inputCols=["t"], upperQuantile=0.5).fit(y)
    back = [r["t"] for r in model.inverse(model.transform(y)).collect()]
    assert back[-1] is None and back[:4] == pytest.approx([0.0, 0.0, 6.25, 6.25])
    plain = TargetTransformer(inputCols=["t"], clipUpper=False, logTransform=False).fit(y)
    assert [r["t"] for r in plain.transform(y).collect()] == [0.0, 0.0, 12.5, 400.0, None]


def test_models_are_saved_and_loaded(spark, tmp_path):
    train = spark.createDataFrame([(float(i), None if i % 4 else 1.0) for i in range(50)], "a double, b double")
    clip = QuantileClipper(inputCols=["a", "b"]).fit(train)
    pipeline = PipelineModel([clip, MedianImputer(inputCols=["a", "b"]).fit(clip.transform(train))])
    pipeline.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    assert again.transform(train).collect() == pipeline.transform(train).collect()
    target = TargetTransformer(inputCols=["a"], clipUpper=False).fit(train)
    target.save(str(tmp_path / "t"))
    assert TargetTransformerModel.load(str(tmp_path / "t")).bounds() == target.bounds() == {"a": (0.0, None)}


def test_iqr_cap(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)] + [(1000.0,), (None,)], "x double")
    got = [r["x"] for r in cap_outliers(df, ["x", "absent"]).collect()]
    assert got[-2] == 13.0 and got[-1] is None and got[:8] == [float(i) for i in range(1, 9)]
