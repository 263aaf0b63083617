"""Risk bands as struct columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double_or_zero
from sensorspark.functions.text import strip


def _pick(score: Column, position: int) -> Column:
    """Attribute of a four-level score, as a CASE over the fixed rows."""
    out = None
    for row in K.RISK_LEVELS:
        out = (F.when if out is None else out.when)(score == row[0], F.lit(row[position]))
    return out


def risk_score(pm2_5: Column, pm10: Column, so2: Column) -> Column:
    """1 to 4. Missing or unreadable readings count as zero."""
    values = [to_double_or_zero(c) for c in (pm2_5, pm10, so2)]
    out = None
    for level in sorted(K.RISK_FLOORS, reverse=True):
        over = None
        for value, floor in zip(values, K.RISK_FLOORS[level]):
            over = value > floor if over is None else over | (value > floor)
        out = (F.when if out is None else out.when)(over, F.lit(level))
    return out.otherwise(F.lit(1))


def risk_drivers(pm2_5: Column, pm10: Column, so2: Column) -> Column:
    """Labels of the pollutants above the lowest floor."""
    labels = K.POLLUTANT_LABELS.values()
    over = F.array_compact(F.array(*[
        F.when(to_double_or_zero(value) > floor, F.lit(label))
        for value, floor, label in zip((pm2_5, pm10, so2), K.RISK_FLOORS[2], labels)
    ]))
    return F.when(F.size(over) > 0, over).otherwise(F.array(F.lit(K.NO_DRIVER_TEXT)))


def risk_four_level(pm2_5: Column, pm10: Column, so2: Column) -> Column:
    score = risk_score(pm2_5, pm10, so2)
    category = _pick(score, 1)
    return F.struct(
        category.alias("category"),
        category.alias("risk_category"),
        category.alias("label"),
        _pick(score, 2).alias("risk_level"),
        score.alias("score"),
        score.alias("level"),
        _pick(score, 3).alias("color"),
        _pick(score, 4).alias("recommendation"),
        risk_drivers(pm2_5, pm10, so2).alias("drivers"),
    )


def risk_five_level(pm2_5: Column, pm10: Column, so2: Column | None = None) -> Column:
    values = [to_double_or_zero(c) for c in (pm2_5, pm10, F.lit(0.0) if so2 is None else so2)]

    def banded(position: int) -> Column:
        out = None
        for band in K.RISK_BANDS:
            if band[0] is None:
                return out.otherwise(F.lit(band[position]))
            within = None
            for value, ceiling in zip(values, band[0]):
                within = value <= ceiling if within is None else within & (value <= ceiling)
            out = (F.when if out is None else out.when)(within, F.lit(band[position]))
        return out

    color, message = banded(3), banded(4)
    return F.struct(
        banded(1).alias("category"),
        banded(2).alias("risk_level"),
        message.alias("message"),
        message.alias("health_message"),
        message.alias("recommendation"),
        color.alias("badge_color"),
        color.alias("color"),
        F.lit(K.RISK_DISCLAIMER).alias("explanation"),
        F.lit(K.RISK_DISCLAIMER).alias("disclaimer"),
    )


def category_of_score(score: Column) -> Column:
    """Category of any score; scores outside 1 to 4 are moved to the nearest end."""
    bounded = F.least(F.greatest(score.cast("int"), F.lit(1)), F.lit(len(K.RISK_LEVELS)))
    return F.when(score.isNotNull(), _pick(bounded, 1))


def category_attribute(category: Column, attribute: str) -> Column:
    """risk_level, color or recommendation of a category name; unknown names read as Moderate."""
    position = {"risk_level": 2, "color": 3, "recommendation": 4}[attribute]
    key = F.lower(strip(category))
    out = None
    for row in K.RISK_LEVELS:
        out = (F.when if out is None else out.when)(key == row[1].lower(), F.lit(row[position]))
    return out.otherwise(F.lit(K.RISK_LEVELS[1][position]))
