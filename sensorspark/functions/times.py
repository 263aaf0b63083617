"""Timestamp functions on TIMESTAMP_NTZ, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double
from sensorspark.functions.text import bound, strip

_DAY_US = 86_400_000_000
# Serial day numbers that stay inside the years 1677 to 2262.
_SERIAL_RANGE = (-81_185, 132_313)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock, rounded down.

    Put together from date and clock parts: the difference of two timestamps
    would go through the session zone.
    """
    clock = F.hour(ts) * F.lit(3600) + F.minute(ts) * F.lit(60) + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * F.lit(86_400) + clock


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 on the wall clock."""
    part = F.extract(F.lit("SECOND"), ts) % F.lit(1)
    return seconds(ts) * F.lit(1_000_000) + (part * F.lit(1_000_000)).cast("bigint")


def from_seconds(count: Column) -> Column:
    return F.timestamp_add("SECOND", count, ntz("1970-01-01 00:00:00"))


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, ntz("1970-01-01 00:00:00"))


def floor_to(ts: Column, step: int) -> Column:
    """Last multiple of the step (in seconds) at or before the time."""
    sec = seconds(ts)
    return from_seconds(sec - F.pmod(sec, F.lit(step)))


def round_to(ts: Column, step: int | Column) -> Column:
    """Nearest multiple of an even step in seconds; exact halves go to the even multiple."""
    step = F.lit(step) if isinstance(step, int) else step
    sec = seconds(ts)
    rest = F.pmod(sec, step)
    low = sec - rest
    odd = F.pmod(low, step * 2) != 0
    # A fraction of a second only matters right at the middle.
    half = (rest * 2 == step) & (odd | (ts > from_seconds(sec)))
    return from_seconds(F.when((rest * 2 > step) | half, low + step).otherwise(low))


def align_to_granularity(ts: Column, granularity: Column) -> Column:
    """Round to the step of the row's granularity; unknown granularity is left alone."""
    step = None
    for name, size in K.STEP_SECONDS.items():
        step = (F.when if step is None else step.when)(granularity == name, F.lit(size))
    return F.coalesce(round_to(ts, step), ts)


def from_serial(days: Column) -> Column:
    """Spreadsheet day number (day 0 = 1899-12-30) to a timestamp."""
    us = F.round(days * F.lit(float(_DAY_US))).cast("bigint")
    return F.when(
        days.between(*_SERIAL_RANGE), F.timestamp_add("MICROSECOND", us, ntz("1899-12-30 00:00:00"))
    )


# Each shape is (pattern, replacement that spells it as y-m-d h:m:s). A spelled
# text fits none of the day-first patterns again, so shapes can be applied in a row.
_TIME = r"(?:[\sT]+(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?))"
_YEAR_FIRST = (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}?$", "$1-$2-$3 $4")
_DAY_FIRST = (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}){_TIME}?$", "$3-$2-$1 $4")
_MONTH_FIRST = (rf"^(\d{{1,2}})[-/](\d{{1,2}})[-/](\d{{4}}){_TIME}?$", "$3-$1-$2 $4")
_SHORT_YEAR_20 = (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.]([0-6]\d|7[0-5]){_TIME}?$", "20$3-$2-$1 $4")
_SHORT_YEAR_19 = (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](7[6-9]|[89]\d){_TIME}?$", "19$3-$2-$1 $4")
_NO_SECONDS = (r"^(\S+ \d{1,2}:\d{1,2})$", "$1:00")
_SPELLED = r"^\d{4}-\d{1,2}-\d{1,2} ?(\d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?)?$"


def _from_shapes(text: Column, *shapes: tuple[str, str]) -> Column:
    """Timestamp of a text in one of the shapes. The cast is zone-free and rejects days like 31-02."""
    out = text
    for pattern, spelled in (*shapes, _NO_SECONDS):
        out = F.regexp_replace(out, pattern, spelled)
    return bound(out, lambda o: F.when(o.rlike(_SPELLED), F.trim(o).try_cast("timestamp_ntz")))


# Month names, found anywhere between non-letters, spelled as numbers.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH_NAME = r"(?i)(?<![a-z])(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_NAMED_DAY_FIRST = (r"^(\d{1,2})(?:st|nd|rd|th)?[-/., ]+@(\d{2})[-/., ]+(\d{4}|\d{2})(?![\d:])", "$1-$2-$3")
_NAMED_MONTH_FIRST = (r"^@(\d{2})[-/., ]+(\d{1,2})(?:st|nd|rd|th)?[-/., ]+(\d{4}|\d{2})(?![\d:])", "$2-$1-$3")
_NAMED_YEAR_FIRST = (r"^(\d{4})[-/., ]+@(\d{2})[-/., ]+(\d{1,2})(?!\d)", "$3-$2-$1")
_COMPACT = (r"^(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2})(\d{2})(\d{2})?)?$", "$1-$2-$3 $4:$5:$6")
_HALF_DAY = r"(?i)(\d{1,2})(?::(\d{2}))?(?::(\d{2}))? ?([ap])\.?m\.?$"


def _named_month(text: Column) -> Column:
    """`1 January 2024`, `Jan 1, 2024`, `2024 Jan 1` and the like as day-month-year numbers."""
    month = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.lower(F.regexp_extract(text, _MONTH_NAME, 1)))
    out = F.regexp_replace(text, F.lit(_MONTH_NAME), F.concat(F.lit("@"), F.lpad(month.cast("string"), 2, "0")))
    for pattern, spelled in (_NAMED_DAY_FIRST, _NAMED_MONTH_FIRST, _NAMED_YEAR_FIRST):
        out = F.regexp_replace(out, pattern, spelled)
    return F.regexp_replace(out, r"^(\S+),? +(?=\d)", "$1 ")


def _whole_day(text: Column) -> Column:
    """A time of day with AM or PM on the clock of 24 hours."""
    part = lambda i: F.regexp_extract(text, _HALF_DAY, i)
    hour = part(1).try_cast("int") % 12 + F.when(F.lower(part(4)) == "p", 12).otherwise(0)
    two = lambda c: F.lpad(F.when(c == "", "0").otherwise(c), 2, "0")
    time = F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), two(part(2)), two(part(3)))
    valid = part(1).try_cast("int").between(1, 12)
    return F.when(text.rlike(_HALF_DAY) & valid, F.regexp_replace(text, F.lit(_HALF_DAY), time)).otherwise(text)


def parse_datetime(col: Column) -> Column:
    """Date cell of a workbook: serial number, then the known layouts, then other day-first ones.

    Text that looks like a number in the range of serial numbers is one before anything else. The
    known layouts are d-m-y and d/m/y with or without seconds and ISO. Others are read day
    first: date only, dots or mixed separators, `T`, fractions of a second, two-digit years,
    month names in any place, AM and PM, and digits without separators.
    """
    shapes = (_YEAR_FIRST, _DAY_FIRST, _SHORT_YEAR_20, _SHORT_YEAR_19)
    return bound(strip(col), lambda text: F.coalesce(
        bound(to_double(text), from_serial),
        _from_shapes(text, *shapes),
        F.when(text.rlike("[A-Za-z]{2}"), bound(_whole_day(_named_month(text)), lambda t: _from_shapes(t, *shapes))),
        F.when(text.rlike(_COMPACT[0]), bound(F.regexp_replace(F.regexp_replace(text, *_COMPACT), r":+$| :*$", ""),
                                              lambda t: _from_shapes(t, _YEAR_FIRST))),
    ))


def coerce_datetime(col: Column) -> Column:
    """Lenient conversion of stored timestamps: ISO text, then month-first, then day-first."""
    return bound(strip(col), lambda text: F.coalesce(
        _from_shapes(text, _YEAR_FIRST, _MONTH_FIRST), _from_shapes(text, _DAY_FIRST)))


def request_time(col: Column) -> Column:
    """Time of a scoring request: blank means this hour, unreadable text is NULL."""
    text = strip(col)
    blank = text.isNull() | (text == "")
    return F.when(blank, floor_to(F.localtimestamp(), 3600)).otherwise(coerce_datetime(text))


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.day(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def _cycle(name: str, value: Column, period: float) -> dict[str, Column]:
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def calendar_features(ts: Column) -> dict[str, Column]:
    """Nine calendar columns and five sine/cosine pairs."""
    weekday, yearday = F.weekday(ts), F.dayofyear(ts)
    parts = calendar_parts(ts)
    return {
        **parts,
        "day_of_week": weekday,
        "day_of_year": yearday,
        "week_of_year": F.weekofyear(ts),
        "is_weekend": (weekday >= 5).cast("int"),
        **_cycle("hour", parts["hour"], 24),
        **_cycle("minute", parts["minute"], 60),
        **_cycle("day_of_week", weekday, 7),
        **_cycle("month", parts["month"], 12),
        **_cycle("day_of_year", yearday, 365.25),
    }


def cyclic_features(ts: Column) -> dict[str, Column]:
    """Small calendar set; the weekend flag is NULL when the time is."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        **_cycle("hour", F.hour(ts), 24),
        **_cycle("month", F.month(ts), 12),
    }


def peak_features(ts: Column) -> dict[str, Column]:
    """Small calendar set with rush-hour flags; the flags are 0 when the time is NULL."""
    def flag(condition: Column) -> Column:
        return F.coalesce(condition.cast("int"), F.lit(0))

    hour = F.hour(ts)
    return {
        "hour": hour,
        "day": F.day(ts),
        "month": F.month(ts),
        "day_of_week": F.weekday(ts),
        "is_weekend": flag(F.weekday(ts) >= 5),
        "is_morning_peak": flag(hour.between(7, 10)),
        "is_evening_peak": flag(hour.between(17, 21)),
        **_cycle("hour", hour, 24),
        **_cycle("month", F.month(ts), 12),
    }


def wind_vector(degrees: Column) -> dict[str, Column]:
    return {"wd_sin": F.sin(F.radians(degrees)), "wd_cos": F.cos(F.radians(degrees))}
