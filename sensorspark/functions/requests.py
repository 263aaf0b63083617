"""Scoring requests as columns: aliases, defaults and range checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double


def reading_columns(df: DataFrame, coalesce_nulls: bool = False) -> dict[str, Column]:
    """Canonical reading columns of a request table.

    Absent sensors take their default. A sensor that is present but NULL stays
    missing, unless coalesce_nulls=True (request forms, where the canonical
    name, its aliases and the default are tried in that order per row).
    """
    have = {name.lower(): name for name in df.columns}
    out = {}
    for sensor in K.SENSORS:
        default = K.READING_DEFAULTS.get(sensor)
        found = [to_double(F.col(f"`{have[n]}`")) for n in (sensor, *K.READING_ALIASES[sensor]) if n in have]
        missing = F.lit(default).cast("double")
        if not found:
            out[sensor] = missing
        elif coalesce_nulls:
            out[sensor] = F.coalesce(*found, missing)
        else:
            out[sensor] = F.coalesce(*found)
    return out


def violations(df: DataFrame, region: str = "region", strategy: str = "strategy") -> Column:
    """Names of the columns outside their accepted range or list; NULL readings are fine."""
    have = {name.lower(): name for name in df.columns}
    rules = []
    for sensor, (low, high) in K.READING_BOUNDS.items():
        for name in (sensor, *K.READING_ALIASES[sensor]):
            if name not in have:
                continue
            value = F.col(f"`{have[name]}`").try_cast("double")
            bad = F.isnan(value)
            if low is not None:
                bad = bad | (value < low)
            if high is not None:
                bad = bad | (value > high)
            rules.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)))
    for name, allowed in ((region, K.REGIONS), (strategy, K.REQUEST_STRATEGIES)):
        if name in have:
            bad = ~F.coalesce(F.col(name).isin(*allowed), F.lit(False))
            rules.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
