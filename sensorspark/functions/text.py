"""Text, header and path functions on string columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K

_BLANK_ENDS = r"^\s+|\s+$"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(col.cast("string"), _BLANK_ENDS, "")


def clean_text(col: Column) -> Column:
    """Stripped text; empty text becomes NULL."""
    return F.nullif(strip(col), F.lit(""))


def snake_case(col: Column) -> Column:
    """`PM2.5 (ug/m3)` -> `pm2_5_ug_m3`, `windSpeed` -> `wind_speed`."""
    out = strip(col)
    for pattern in K.CAMEL_SPLITS:
        out = F.regexp_replace(out, pattern, "$1_$2")
    for sign, word in K.HEADER_WORDS:
        out = F.replace(out, F.lit(sign), F.lit(word))
    out = F.regexp_replace(out, "[^A-Za-z0-9]+", "_")
    return F.lower(F.regexp_replace(out, "^_+|_+$", ""))


def slug(col: Column) -> Column:
    """Lower-case text with every other run of characters turned into one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def canonical_header(col: Column) -> Column:
    """Canonical sensor name of a header cell; unknown headers stay as snake case, blanks are empty.

    A canonical name matches when it is the whole header, is followed by an
    underscore, or is followed by letters and underscores only. Alternation is
    ordered, so the first canonical name that fits wins.
    """
    text = snake_case(col)
    for old, new in K.HEADER_SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    names = "|".join(K.CANONICAL_NAMES)
    return F.regexp_replace(text, f"^({names})(?:_.*|[a-z_]*[a-z][a-z_]*)$", "$1")


def normalize_header(col: Column) -> Column:
    """Same, blanks NULL."""
    return F.nullif(canonical_header(col), F.lit(""))


def number_repeats(names: Column) -> Column:
    """Second, third... equal entries of a name array get `_2`, `_3`; empty entries become NULL.

    Pass a stored column: the entries are compared with each other.
    """
    def numbered(name, pos):
        seen = F.size(F.filter(F.slice(names, F.lit(1), pos + 1), lambda other: other == name))
        return F.when(name == "", F.lit(None)).when(
            seen > 1, F.concat(name, F.lit("_"), seen.cast("string"))).otherwise(name)

    return F.transform(names, numbered)


def normalize_region(col: Column, strict: bool = False) -> Column:
    """Station name from free text; unknown -> NULL, or an error with strict=True."""
    key = F.replace(F.upper(strip(col)), F.lit(" "), F.lit("_"))
    aliases = F.create_map(*[F.lit(x) for pair in K.REGION_ALIASES.items() for x in pair])
    name = F.coalesce(F.try_element_at(aliases, key), key)
    unknown = (
        F.raise_error(F.concat(F.lit("unknown region: "), F.coalesce(col.cast("string"), F.lit("NULL"))))
        if strict else F.lit(None).cast("string")
    )
    return F.when(name.isin(*K.REGIONS), name).otherwise(unknown)


def target_label(col: Column) -> Column:
    """`pm2_5`, `PM25`, `pm2.5` -> `PM2.5`; other names upper case."""
    name = F.replace(F.upper(strip(col)), F.lit("_"), F.lit("."))
    return F.when(name == "PM25", F.lit("PM2.5")).otherwise(name)


def strategy_name(scope: Column, family: Column) -> Column:
    return F.concat_ws("_", scope, family)


def granularity(time_base: Column, source: Column, strict: bool = False) -> Column:
    """Quarter-hour tokens win over hour tokens.

    By default any "15" counts, also one inside a year. strict=True wants the 15
    next to a minute unit.
    """
    token = F.lower(F.concat_ws(" ", F.coalesce(time_base, F.lit("")), source))
    quarter = r"(^|[^0-9])15\s*[-_ ]?\s*min|qua" if strict else "15|qua"
    return (
        F.when(token.rlike(quarter), F.lit("quarter_hourly"))
        .when(token.rlike("hou"), F.lit("hourly"))
        .otherwise(F.lit("unknown"))
    )


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def file_stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/+[^/]*/*$", 1)


def region_from_path(path: Column) -> Column:
    """First station named anywhere in the path, else an upper-case slug of the file stem."""
    low = F.lower(path)
    out = F.upper(slug(file_stem(path)))
    for region in reversed(K.REGIONS):
        out = F.when(F.contains(low, F.lit(region.lower())), F.lit(region)).otherwise(out)
    return out


def region_order(col: Column) -> Column:
    """Sort rank of a station: report order, unknown ones last (99)."""
    pos = F.array_position(F.array(*[F.lit(r) for r in K.REGIONS]), col)
    return F.when(pos > 0, (pos - 1).cast("int")).otherwise(F.lit(99))


def year_from_path(path: Column) -> Column:
    """First `20dd` of the path as an int."""
    return F.nullif(F.regexp_extract(path, r"(20\d{2})", 1), F.lit("")).try_cast("int")


def exclusion_token(path: Column) -> Column:
    """First token of the exclusion list found in the path, else NULL."""
    low = F.lower(path)
    return F.coalesce(*[
        F.when(F.contains(low, F.lit(token)), F.lit(token)) for token in K.EXCLUDED_PATH_TOKENS
    ])


def exclusion_reason(path: Column) -> Column:
    return F.concat(F.lit("Excluded by path token: "), exclusion_token(path))


def is_workbook(path: Column) -> Column:
    """Known workbook suffix and not a lock file."""
    suffixes = "|".join(s.lstrip(".") for s in K.WORKBOOK_SUFFIXES)
    return F.lower(path).rlike(rf"\.({suffixes})$") & ~F.startswith(file_name(path), F.lit("~$"))


def is_day_sheet(sheet: Column) -> Column:
    """Sheets named 1 to 31, also when the name was stored as `7.0`."""
    return F.coalesce(sheet.rlike(r"^\s*(0?[1-9]|[12]\d|3[01])(\.0)?\s*$"), F.lit(False))
