"""Lag, rolling, target, indicator and one-hot features."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.times import calendar_features, peak_features, cyclic_features, wind_vector
from sensorspark.operators.series import enough, guarded, over_series, previous_rows


def add_calendar(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """Calendar columns, cyclic pairs and, when wind direction is there, its sine and cosine."""
    extra = wind_vector(F.col("wd")) if "wd" in df.columns else {}
    return df.withColumns({**calendar_features(F.col(ts)), **extra})


def add_cyclic(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.withColumns(cyclic_features(F.col(ts)))


def add_peaks(df: DataFrame, ts: str = "date_time") -> DataFrame:
    return df.withColumns(peak_features(F.col(ts)))


def lag_columns(window: WindowSpec, columns: Iterable[str], lags: Iterable[int]) -> dict[str, Column]:
    lags = list(lags)
    return {f"{c}_lag_{k}": F.lag(c, k).over(window) for c in columns for k in lags}


def rolling_columns(window: WindowSpec, columns: Iterable[str], windows: Iterable[int]) -> dict[str, Column]:
    """Mean and sample deviation of the previous w rows, from max(2, w // 2) readings on."""
    out, windows = {}, list(windows)
    frames = {w: previous_rows(window, w) for w in windows}
    for c in columns:
        for w, frame in frames.items():
            known = enough(c, frame, max(2, w // 2))
            out[f"{c}_roll_mean_{w}"] = F.when(known, F.avg(c).over(frame))
            out[f"{c}_roll_std_{w}"] = F.when(known, F.stddev_samp(c).over(frame))
    return out


def target_columns(window: WindowSpec, targets: Iterable[str], horizon: int) -> dict[str, Column]:
    """Readings `horizon` rows ahead and whether that row was observed."""
    out = {"observed_future": F.lead("observed_row", horizon).over(window)}
    out.update({f"target_{t}": F.lead(F.col(t), horizon).over(window) for t in targets})
    return out


def add_group_lags(df: DataFrame, columns: Sequence[str] = K.TARGETS, lags: Sequence[int] = (1,),
                   region: str = "region", ts: str = "date_time", order: Sequence[str] = (),
                   **chunking) -> DataFrame:
    """Row lags per region on readings that need not lie on a grid. Unknown columns are skipped."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return over_series(df, lambda w: lag_columns(w, present, lags), region=region, ts=ts, order=order,
                       back=max(lags), **chunking)


def add_short_history(df: DataFrame, columns: Sequence[str], region: str = "region", ts: str = "date_time",
                      order: Sequence[str] = (), **chunking) -> DataFrame:
    """Fixed lags and full-window rolling mean, deviation, minimum and maximum per region."""
    def build(window: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in columns:
            out.update(lag_columns(window, [c], K.SHORT_LAGS))
            for w in K.SHORT_WINDOWS:
                frame = previous_rows(window, w)
                out[f"{c}_rolling_mean_{w}"] = guarded(F.avg(c), F.col(c), frame, w)
                out[f"{c}_rolling_std_{w}"] = guarded(F.stddev_samp(c), F.col(c), frame, w)
            day = previous_rows(window, 24)
            out[f"{c}_rolling_min_24"] = guarded(F.min(c), F.col(c), day, 24)
            out[f"{c}_rolling_max_24"] = guarded(F.max(c), F.col(c), day, 24)
        return out

    group = region if region in df.columns else None
    return over_series(df, build, region=group, ts=ts, order=order, back=24, **chunking)


def add_missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({
        f"is_missing_{c}": F.col(c).isNull().cast("int") for c in columns if c in df.columns
    })


def learn_regions(df: DataFrame, region: str = "region") -> list[str]:
    """Sorted distinct station names. They become column names, so they must be known to the plan."""
    return [r[0] for r in df.select(region).where(F.col(region).isNotNull()).distinct().orderBy(region).collect()]


def add_region_one_hot(df: DataFrame, regions: Sequence[str], region: str = "region") -> DataFrame:
    return df.withColumns({
        f"region_{name}": F.coalesce((F.col(region) == name).cast("int"), F.lit(0)) for name in regions
    })


_ROLLED = re.compile(r"^(.+)_roll_(mean|std)_\d+$")


def cold_start_features(readings: DataFrame, features: Sequence[str], region: str = "region",
                        ts: str = "date_time", keep: Sequence[str] = ()) -> DataFrame:
    """Feature rows for readings without history: lags and means repeat the reading, deviations are 0.

    The select is generated from the feature list, so one plan serves any number
    of readings and keeps the exact column order. Unknown features are NULL.
    """
    calendar = calendar_features(F.col(ts))
    wind = wind_vector(F.col("wd")) if "wd" in readings.columns else {}

    def current(name: str) -> Column:
        return F.col(name).cast("double") if name in readings.columns and name in K.SENSORS \
            else F.lit(None).cast("double")

    def feature(name: str) -> Column:
        rolled = _ROLLED.match(name)
        if name.startswith("region_"):
            return (F.col(region) == name[len("region_"):]).cast("int")
        if "_lag_" in name:
            return current(name.rsplit("_lag_", 1)[0])
        if rolled and rolled[2] == "mean":
            return current(rolled[1])
        if rolled:
            return F.when(current(rolled[1]).isNotNull(), F.lit(0.0))
        return calendar.get(name, wind.get(name, current(name)))

    kept = [F.col(c) for c in keep if c not in features]
    return readings.select(*kept, *[feature(name).alias(name) for name in features])
