"""Rule-based next-step forecast: a model-free strategy made of column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import clip, to_double_or_zero


def _signals(values: Mapping[str, Column], hour: Column, month: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    above = lambda name, start, scale: F.greatest(zero, to_double_or_zero(values[name]) - start) / scale
    return {
        **{t: to_double_or_zero(values[t]) for t in K.TARGETS},
        "rush": F.when(hour.between(17, 21), K.RULE_EVENING_RUSH).when(hour.between(7, 10), K.RULE_MORNING_RUSH).otherwise(zero),
        "night": F.when((hour >= 22) | (hour <= 5), K.RULE_NIGHT).otherwise(zero),
        "winter": F.when((month >= 11) | (month <= 2), 1.0).otherwise(zero),
        "humid": above("hum", *K.RULE_HUMIDITY),
        "wind": F.least(to_double_or_zero(values["ws"]), F.lit(K.RULE_WIND_CAP)) / K.RULE_WIND_SCALE,
        "heat": above("temp", *K.RULE_HEAT),
    }


def region_offset(region: Column, target: str) -> Column:
    """Additive station offset; unknown stations use the first one."""
    position = K.TARGETS.index(target)
    out = None
    for name in K.REGIONS:
        out = (F.when if out is None else out.when)(region == name, F.lit(K.RULE_OFFSETS[name][position]))
    return out.otherwise(F.lit(K.RULE_OFFSETS[K.REGIONS[0]][position]))


def rule_forecast(region: Column, values: Mapping[str, Column], hour: Column, month: Column) -> dict[str, Column]:
    """Forecast per target from the current readings, hour and month."""
    signals = _signals(values, hour, month)
    out = {}
    for target in K.TARGETS:
        total = region_offset(region, target)
        for signal, weight in K.RULE_WEIGHTS[target].items():
            total = total + signals[signal] * weight
        out[target] = clip(total, 0.0, K.RULE_UPPER[target])
    return out
