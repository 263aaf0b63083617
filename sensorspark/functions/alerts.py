"""Threshold alerts as arrays of structs, and the trend spike verdict."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double_or_zero


def _alert(value: Column, pollutant: str, threshold: float, message: str) -> Column:
    value = to_double_or_zero(value)
    severity = F.when(value >= threshold * K.HIGH_SEVERITY_FACTOR, F.lit("high")).otherwise(F.lit("elevated"))
    return F.when(
        value >= threshold,
        F.struct(
            F.lit(pollutant).alias("pollutant"),
            F.round(value, 3).alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            severity.alias("severity"),
            F.lit(message).alias("message"),
        ),
    )


def spike_alerts(values: Mapping[str, Column], thresholds: Mapping[str, float] | None = None) -> Column:
    """Alerts of the pollutants at or above their threshold; absent readings count as zero."""
    active = {**K.SPIKE_THRESHOLDS, **(thresholds or {})}
    return F.array_compact(F.array(*[
        _alert(values.get(name, F.lit(0.0)), name, limit,
               K.SPIKE_ALERT_TEXT.format(pollutant=name.upper()))
        for name, limit in active.items()
    ]))


def review_alerts(values: Mapping[str, Column], thresholds: Mapping[str, float] = K.REVIEW_THRESHOLDS) -> Column:
    """Alerts on the readings themselves, with the lower review thresholds."""
    return F.array_compact(F.array(*[
        _alert(values.get(name, F.lit(0.0)), name, limit,
               K.REVIEW_ALERT_TEXT.format(pollutant=K.POLLUTANT_LABELS.get(name, name.upper())))
        for name, limit in thresholds.items()
    ]))


def combined_review(forecast_alerts: Column, reading_alerts: Column) -> Column:
    """Forecast alerts first, then reading alerts of pollutants not alerted yet."""
    known = F.transform(forecast_alerts, lambda a: a["pollutant"])
    fresh = F.filter(reading_alerts, lambda a: ~F.array_contains(known, a["pollutant"]))
    return F.concat(forecast_alerts, fresh)


def trend_spike(current: Column, mean: Column, std: Column, pollutant: Column) -> Column:
    """Verdict on a value against the recent mean and deviation; NULL without a trend."""
    sigma = F.greatest(std, F.lit(1e-6))
    high, medium = current > mean + 3 * sigma, current > mean + 2 * sigma
    spiking = high | medium
    ratio = F.when(mean > 0, current / F.nullif(mean, F.lit(0.0))).otherwise(F.lit(0.0))
    message = F.when(
        spiking,
        F.concat(pollutant, F.lit(K.TREND_ALERT_TEXT)),
    ).otherwise(F.concat(pollutant, F.lit(K.TREND_NORMAL_TEXT)))
    known = current.isNotNull() & mean.isNotNull() & std.isNotNull()
    return F.when(known, F.struct(
        spiking.alias("is_spike"),
        F.when(high, F.lit("High")).when(medium, F.lit("Medium")).otherwise(F.lit("Normal")).alias("severity"),
        F.round(ratio, 2).alias("spike_ratio"),
        message.alias("message"),
    ))


def watch_list(readings: Mapping[str, Column], forecasts: Mapping[str, Column]) -> Column:
    """Texts of the pollutants whose reading or forecast reaches the review threshold."""
    entries = []
    for name, limit in K.REVIEW_THRESHOLDS.items():
        worst = F.greatest(to_double_or_zero(readings[name]), to_double_or_zero(forecasts[name]))
        # One decimal, halves upward.
        shown = F.call_function("format_number", F.floor(worst * 10 + F.lit(0.5)) / 10, F.lit("0.0"))
        entries.append(F.when(worst >= limit, F.concat(F.lit(K.WATCH_TEXTS[name]), shown, F.lit(" ug/m3"))))
    return F.array_compact(F.array(*entries))


def primary_driver(pm2_5: Column, pm10: Column) -> Column:
    return F.when(pm10 >= pm2_5 * K.PM10_DRIVER_RATIO, F.lit(K.PM10_DRIVER)).otherwise(F.lit(K.PM2_5_DRIVER))


def weather_signal(wind: Column) -> Column:
    return F.when(to_double_or_zero(wind) <= K.CALM_WIND, F.lit(K.CALM_TEXT)).otherwise(F.lit(K.WINDY_TEXT))
