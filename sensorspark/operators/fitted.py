"""Transforms whose parameters are learned from the training rows.

All are `pyspark.ml` estimators that only emit SQL expressions: clip by
quantiles, fill with medians, transform targets. A fitted model holds plain
numbers, so it is saved and loaded like any other pipeline stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import clip
from sensorspark.operators.quantiles import quantiles

_OPEN = float("inf")


def _replace(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One projection for all replaced and added columns."""
    kept = [columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, *[v.alias(c) for c, v in columns.items() if c not in df.columns])


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    exact = Param(Params._dummy(), "exact", "exact or approximate quantiles", TypeConverters.toBoolean)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(exact=True)

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class _Bounds(_Columns):
    lower = Param(Params._dummy(), "lower", "lower bounds", TypeConverters.toListFloat)
    upper = Param(Params._dummy(), "upper", "upper bounds", TypeConverters.toListFloat)

    def bounds(self) -> dict[str, tuple[float | None, float | None]]:
        def closed(x: float) -> float | None:
            return None if abs(x) == _OPEN else x
        low, high = self.getOrDefault(self.lower), self.getOrDefault(self.upper)
        return {c: (closed(lo), closed(hi)) for c, lo, hi in zip(self.columns(), low, high)}


class QuantileClipperModel(Model, _Bounds, DefaultParamsReadable, DefaultParamsWritable):
    @classmethod
    def of(cls, bounds: dict[str, tuple[float | None, float | None]]) -> "QuantileClipperModel":
        return cls()._set(
            inputCols=list(bounds),
            lower=[-_OPEN if lo is None else lo for lo, _ in bounds.values()],
            upper=[_OPEN if hi is None else hi for _, hi in bounds.values()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bounds = self.bounds()

        def limited(c: str) -> str:
            value = f"CAST(`{c}` AS DOUBLE)"
            lo, hi = bounds[c]
            out = value if lo is None else f"greatest({value}, {lo!r}D)"
            out = out if hi is None else f"least({out}, {hi!r}D)"
            return f"CASE WHEN `{c}` IS NOT NULL THEN {out} END AS `{c}`"

        # SQL text, as hundreds of columns are built in one call.
        return dataset.selectExpr(*[limited(c) if c in bounds else f"`{c}`" for c in dataset.columns])


class QuantileClipper(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Limit features to two quantiles of the training rows."""

    lowerQuantile = Param(Params._dummy(), "lowerQuantile", "lower quantile", TypeConverters.toFloat)
    upperQuantile = Param(Params._dummy(), "upperQuantile", "upper quantile", TypeConverters.toFloat)

    def __init__(self, *, inputCols=None, lowerQuantile=K.FEATURE_CLIP[0], upperQuantile=K.FEATURE_CLIP[1], exact=True):
        super().__init__()
        self._set(inputCols=inputCols, lowerQuantile=lowerQuantile, upperQuantile=upperQuantile, exact=exact)

    def _fit(self, dataset: DataFrame) -> QuantileClipperModel:
        probabilities = [self.getOrDefault(self.lowerQuantile), self.getOrDefault(self.upperQuantile)]
        found = quantiles(dataset, self.columns(), probabilities, self.getOrDefault(self.exact))
        return QuantileClipperModel.of({c: tuple(found[c]) for c in self.columns()})


class MedianImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    indicatorCols = Param(Params._dummy(), "indicatorCols", "columns with an indicator", TypeConverters.toListString)

    @classmethod
    def of(cls, medians: dict[str, float | None], flagged: Sequence[str]) -> "MedianImputerModel":
        return cls()._set(inputCols=list(medians), indicatorCols=list(flagged),
                          medians=[0.0 if m is None else m for m in medians.values()])

    def output_columns(self) -> list[str]:
        return [*self.columns(), *[indicator_name(c) for c in self.getOrDefault(self.indicatorCols)]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        medians = dict(zip(self.columns(), self.getOrDefault(self.medians)))
        filled = [f"coalesce(CAST(`{c}` AS DOUBLE), {medians[c]!r}D) AS `{c}`" if c in medians else f"`{c}`"
                  for c in dataset.columns]
        flags = [f"CAST(`{c}` IS NULL AS DOUBLE) AS `{indicator_name(c)}`"
                 for c in self.getOrDefault(self.indicatorCols)]
        return dataset.selectExpr(*filled, *flags)


class MedianImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fill with training medians; columns with gaps in training get an indicator."""

    addIndicator = Param(Params._dummy(), "addIndicator", "add indicator columns", TypeConverters.toBoolean)

    def __init__(self, *, inputCols=None, addIndicator=True, exact=True):
        super().__init__()
        self._set(inputCols=inputCols, addIndicator=addIndicator, exact=exact)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        columns = self.columns()
        found = quantiles(dataset, columns, [0.5], self.getOrDefault(self.exact))
        flagged: list[str] = []
        if self.getOrDefault(self.addIndicator) and columns:
            gaps = dataset.agg(*[F.count_if(F.col(f"`{c}`").isNull()) for c in columns]).first()
            flagged = [c for c, n in zip(columns, gaps) if n]
        return MedianImputerModel.of({c: found[c][0] for c in columns}, flagged)


def indicator_name(column: str) -> str:
    return f"missingindicator_{column}"


class TargetTransformerModel(Model, _Bounds, DefaultParamsReadable, DefaultParamsWritable):
    logTransform = Param(Params._dummy(), "logTransform", "log1p of the clipped value", TypeConverters.toBoolean)

    def forward(self, column: Column, name: str) -> Column:
        out = clip(column, *self.bounds()[name])
        return F.log1p(out) if self.getOrDefault(self.logTransform) else out

    def backward(self, column: Column, name: str) -> Column:
        out = F.expm1(column) if self.getOrDefault(self.logTransform) else column
        return clip(out, *self.bounds()[name])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _replace(dataset, {
            c: self.forward(F.col(f"`{c}`").cast("double"), c) for c in self.columns() if c in dataset.columns})

    def inverse(self, dataset: DataFrame) -> DataFrame:
        return _replace(dataset, {
            c: self.backward(F.col(f"`{c}`").cast("double"), c) for c in self.columns() if c in dataset.columns})


class TargetTransformer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Limit targets to [0, training quantile], then log1p; the model also inverts."""

    upperQuantile = Param(Params._dummy(), "upperQuantile", "upper quantile", TypeConverters.toFloat)
    clipUpper = Param(Params._dummy(), "clipUpper", "use the upper quantile", TypeConverters.toBoolean)
    logTransform = TargetTransformerModel.logTransform

    def __init__(self, *, inputCols=None, upperQuantile=K.TARGET_CLIP_UPPER, clipUpper=True, logTransform=True, exact=True):
        super().__init__()
        self._set(inputCols=inputCols, upperQuantile=upperQuantile, clipUpper=clipUpper, logTransform=logTransform,
                  exact=exact)

    def _fit(self, dataset: DataFrame) -> TargetTransformerModel:
        columns = self.columns()
        found: dict = {c: [None] for c in columns}
        if self.getOrDefault(self.clipUpper):
            found = quantiles(dataset, columns, [self.getOrDefault(self.upperQuantile)], self.getOrDefault(self.exact))
        return TargetTransformerModel()._set(
            inputCols=columns, lower=[0.0] * len(columns),
            upper=[_OPEN if found[c][0] is None else found[c][0] for c in columns],
            logTransform=self.getOrDefault(self.logTransform))


def cap_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5, exact: bool = True) -> DataFrame:
    """Limit columns to the quartiles plus or minus `factor` quartile ranges. Unknown columns are skipped."""
    present = [c for c in columns if c in df.columns]
    found = quantiles(df, present, [0.25, 0.75], exact)
    capped = {}
    for c in present:
        q1, q3 = found[c]
        if q1 is not None:
            spread = factor * (q3 - q1)
            capped[c] = clip(F.col(f"`{c}`"), q1 - spread, q3 + spread)
    return _replace(df, capped)
