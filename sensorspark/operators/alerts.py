"""Alert tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorspark.functions.alerts import trend_spike
from sensorspark.operators.features import rolling_columns
from sensorspark.operators.series import guarded, over_series, previous_rows

ALERT_SCHEMA = "date_time timestamp_ntz, region string, pollutant string, value double, z_score double"


def z_score_columns(window: WindowSpec, pollutants: Sequence[str], size: int) -> dict[str, Column]:
    """Distance from the mean of the previous rows in deviations; NULL without enough spread or rows."""
    least, frame = max(3, size // 4), previous_rows(window, size)
    out = {}
    for name in pollutants:
        col = F.col(name).cast("double")
        mean = guarded(F.avg(col), col, frame, least)
        deviation = guarded(F.stddev_samp(col), col, frame, least)
        out[f"_z_{name}"] = F.try_divide(col - mean, F.nullif(deviation, F.lit(0.0)))
    return out


def rolling_zscore_alerts(df: DataFrame, pollutants: str | Sequence[str], window: int = 24, threshold: float = 3.0,
                          region: str = "region", ts: str = "date_time", order: Sequence[str] = (),
                          **chunking) -> DataFrame:
    """Rows whose reading is `threshold` deviations off the previous `window` rows of the region.

    All pollutants share one window pass. Pollutants the table does not have
    give no rows.
    """
    names = [pollutants] if isinstance(pollutants, str) else list(pollutants)
    names = [n for n in names if n in df.columns]
    if not names:
        return df.sparkSession.createDataFrame([], ALERT_SCHEMA)
    group = region if region in df.columns else None
    keys = [c for c in (ts, region) if c in df.columns]
    slim = df.select(*dict.fromkeys([*keys, *order, *names]))
    scored = over_series(slim, lambda w: z_score_columns(w, names, window), region=group, ts=ts, order=order,
                         back=window, **chunking)
    rows = [F.struct(F.lit(n).alias("pollutant"), F.col(n).cast("double").alias("value"),
                     F.col(f"_z_{n}").alias("z_score")) for n in names]
    out = scored.select(*dict.fromkeys([*keys, *order]), F.inline(F.array(*rows)))
    return out.where(F.abs("z_score") >= threshold)


def trend_alerts(df: DataFrame, pollutant: str, window: int = 24, label: str | None = None,
                 region: str = "region", ts: str = "date_time", **chunking) -> DataFrame:
    """Every row with the verdict on its reading against the rolling mean and deviation before it."""
    def build(w: WindowSpec) -> dict[str, Column]:
        stats = rolling_columns(w, [pollutant], [window])
        return {"_mean": stats[f"{pollutant}_roll_mean_{window}"], "_std": stats[f"{pollutant}_roll_std_{window}"]}

    scored = over_series(df, build, region=region, ts=ts, back=window, **chunking)
    verdict = trend_spike(F.col(pollutant), F.col("_mean"), F.col("_std"), F.lit(label or pollutant))
    return scored.withColumn("spike", verdict).drop("_mean", "_std")
