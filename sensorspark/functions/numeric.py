"""Numeric coercion and null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K

# Keeps out type suffixes (1d), hexadecimal and names of non-finite numbers, which a cast accepts.
_NUMBER_CHARACTERS = r"^[-+.0-9eE]+$"


def finite(col: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def to_double(col: Column) -> Column:
    """Double from text or number; anything that is not a finite number becomes NULL."""
    text = F.trim(col.cast("string"), F.lit(" \t\n\r\x0b\x0c"))
    return finite(F.when(text.rlike(_NUMBER_CHARACTERS), text.try_cast("double")))


def to_double_or_zero(col: Column) -> Column:
    return F.coalesce(to_double(col), F.lit(0.0))


def plausible(col: Column, limit: float = K.IMPOSSIBLE_MAGNITUDE) -> Column:
    """Readings of impossible magnitude become NULL (NaN too, as it sorts above all numbers)."""
    return F.when(F.abs(col) < F.lit(float(limit)), col)


def clip(col: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Limit a value; NULL stays NULL (greatest/least alone would drop it)."""
    out = col
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(col.isNotNull(), out)


def prediction(col: Column) -> Column:
    """Published forecast: not negative, three decimals."""
    return F.round(clip(col, lower=0.0), 3)


def non_null_score(*cols: Column) -> Column:
    """Number of arguments that are not NULL."""
    score = F.lit(0)
    for col in cols:
        score = score + col.isNotNull().cast("int")
    return score
