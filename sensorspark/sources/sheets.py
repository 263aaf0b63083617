"""Workbook cells to typed readings.

Input: one row per sheet row, `region, path, workbook, sheet, row_idx, cells`
with all cells as text. The header row is found inside the data, so nothing is
assumed about where a sheet starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double
from sensorspark.functions.text import (
    bound, canonical_header, clean_text, granularity, is_day_sheet, number_repeats,
    parent_folder, year_from_path,
)
from sensorspark.functions.times import parse_datetime

SHEET = ["region", "path", "workbook", "sheet"]
HEADER_SEARCH_ROWS = 20
MIN_CANONICAL_HEADERS = 4
# First rows of sheets per task: a task sorts its rows in memory.
ROWS_PER_TASK = 250_000
_METRICS = [n for n in K.CANONICAL_NAMES if n != "date_time"]


def day_sheets(cells: DataFrame) -> DataFrame:
    return cells.where(is_day_sheet(F.col("sheet")))


def _header(cells: Column) -> Column:
    """(row_idx, cells, names) of a row that names a date, a time and at least four canonical columns.

    The plain text test comes first; only rows that pass it run the header
    expressions, once, and their names travel on with the row.
    """
    words = F.lower(F.array_join(cells, " | "))
    dated = F.contains(words, F.lit("date")) & F.contains(words, F.lit("time"))

    def accepted(names: Column) -> Column:
        hits = F.size(F.filter(names, lambda n: n.isin(*K.CANONICAL_NAMES)))
        return F.when(hits >= MIN_CANONICAL_HEADERS, F.struct(
            F.col("row_idx"), cells.alias("cells"), names.alias("names")))

    return F.when(dated, bound(F.transform(cells, canonical_header), accepted))


def sheet_headers(cells: DataFrame) -> DataFrame:
    """One row per day sheet: header position, header texts, normalised names and sheet metadata.

    A single aggregate over the first rows of the sheets; `header_row` is NULL
    when no header was found there. The rows are counted first and dealt by sheet to as many
    tasks as they need, so that no task sorts more as the input grows; only header rows carry their cells there.
    """
    top = day_sheets(cells).where(F.col("row_idx") < HEADER_SEARCH_ROWS)
    tasks = max(1, -(-top.count() // ROWS_PER_TASK))

    def meta(row: int) -> Column:
        return F.when(F.col("row_idx") == row, F.get("cells", F.lit(1)))

    slim = top.select(*SHEET, _header(F.col("cells")).alias("_head"),
                      meta(0).alias("_m0"), meta(2).alias("_m2"), meta(3).alias("_m3"))
    heads = slim.repartition(tasks, *SHEET).groupBy(*SHEET).agg(
        F.min("_head").alias("_head"), *[F.max(m).alias(m) for m in ("_m0", "_m2", "_m3")])
    head = F.col("_head")
    return heads.select(
        *SHEET, head["row_idx"].alias("header_row"), head["cells"].alias("header_cells"),
        number_repeats(head["names"]).alias("names"),
        *[clean_text(F.col(c)).alias(n) for c, n in (("_m0", "station_name"), ("_m2", "report_type"), ("_m3", "time_base"))],
    )


def _has_time() -> Column:
    return F.array_contains("names", "date_time")


def rejected_sheets(headers: DataFrame) -> DataFrame:
    """Sheets that cannot be read, with the reason."""
    reason = (
        F.when(F.col("header_row").isNull(), F.lit("Could not find the data header row."))
        .when(~_has_time(), F.concat(F.lit("Sheet '"), "sheet", F.lit("' is missing a normalized date_time column.")))
    )
    return headers.select(*SHEET, reason.alias("reason")).where(F.col("reason").isNotNull())


def column_mapping(headers: DataFrame) -> DataFrame:
    """Distinct (raw header, normalised name) pairs."""
    pairs = headers.where(F.col("header_row").isNotNull()).select(
        F.inline(F.arrays_zip(F.col("header_cells").alias("raw_column_name"),
                              F.col("names").alias("normalized_column_name"))))
    return pairs.where(F.col("normalized_column_name").isNotNull()).distinct()


def column_occurrences(headers: DataFrame) -> DataFrame:
    """Sheets per normalised name."""
    names = headers.where(F.col("header_row").isNotNull()).select(F.explode("names").alias("normalized_column_name"))
    return names.where(F.col("normalized_column_name").isNotNull()).groupBy("normalized_column_name").agg(
        F.count(F.lit(1)).alias("sheets"))


def _layout(headers: DataFrame) -> DataFrame:
    """Position of every canonical name, and name and position of all others, per sheet."""
    at = {n: F.nullif(F.array_position("names", F.lit(n)), F.lit(0)).cast("int") - 1 for n in K.CANONICAL_NAMES}
    others = F.filter(
        F.transform("names", lambda n, i: F.struct(n.alias("name"), i.alias("at"))),
        lambda e: e["name"].isNotNull() & ~e["name"].isin(*K.CANONICAL_NAMES)
        # A generated name like x_2 may repeat a real one: the first column counts.
        & (F.array_position("names", e["name"]) == e["at"] + 1),
    )
    return headers.select(
        *SHEET, "header_row", "station_name", "report_type", "time_base",
        *[c.alias(f"_at_{n}") for n, c in at.items()], others.alias("_others"))


def _cell(name: str) -> Column:
    """Cell below the header `name`; NULL where the sheet has no such column."""
    return F.get("cells", F.col(f"_at_{name}"))


def _data_rows(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows below the units row of readable day sheets, with the layout of their sheet."""
    usable = headers.where(F.col("header_row").isNotNull() & _has_time())
    # A sheet has at most some million rows, so no key of this join can grow hot.
    # Headers are dealt over few tasks; dealt anew, they do not set the tasks of the far more numerous data rows.
    rows = day_sheets(cells).select(*SHEET, "row_idx", "cells").join(_layout(usable).repartition(*SHEET), SHEET)
    return rows.where((F.col("row_idx") >= F.col("header_row") + 2) & F.exists("cells", lambda c: c.isNotNull()))


def undated_rows(cells: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Data rows that `load_sheets` leaves out because their date cell cannot be read, with that cell."""
    data = _data_rows(cells, sheet_headers(cells) if headers is None else headers)
    return data.select(*SHEET, "row_idx", _cell("date_time").alias("date_cell"), F.lit("Could not read the date.").alias("reason")).where(
        parse_datetime(F.col("date_cell")).isNull())


def load_sheets(cells: DataFrame, headers: DataFrame | None = None, root: str = "") -> DataFrame:
    """Typed readings of all readable day sheets with their lineage.

    The layout of the sheet travels to the data rows, where the cells are picked
    by position; there is no pivot and so no second shuffle. Headers outside the
    canonical list go to the `extra` map.
    """
    headers = sheet_headers(cells) if headers is None else headers
    data = _data_rows(cells, headers)
    # Unnesting a filtered one-entry array drops undated rows and parses once; a
    # filter on the parsed column would be pushed down and parse a second time.
    parsed = F.filter(F.array(parse_datetime(_cell("date_time"))), lambda t: t.isNotNull())
    dated = data.select("*", F.explode(parsed).alias("date_time"))
    extra = F.map_from_entries(F.transform(
        "_others", lambda e: F.struct(e["name"], to_double(F.get(F.col("cells"), e["at"])))))
    relative = F.regexp_replace("path", "^" + _quoted(root.rstrip("/")) + "/+", "") if root else F.col("path")
    return dated.select(
        "region", "date_time",
        granularity(F.col("time_base"), F.col("workbook")).alias("granularity"),
        *[to_double(_cell(n)).alias(n) for n in sorted(_METRICS)],
        extra.alias("extra"),
        "station_name", "report_type", "time_base",
        F.col("workbook").alias("source_workbook"),
        relative.alias("source_relative_path"),
        F.col("sheet").alias("source_sheet"),
        parent_folder(F.col("path")).alias("source_month_folder"),
        year_from_path(F.col("path")).alias("source_year"),
    )


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E" if text else ""


def ingest_diagnostics(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Counts of the run in long form: section, name, count."""
    def counted(df: DataFrame, section: str, name: Column) -> DataFrame:
        return df.groupBy(F.lit(section).alias("section"), name.alias("name")).agg(F.count(F.lit(1)).alias("count"))

    files = cells.select("path").distinct()
    with_days = headers.select("path").distinct()
    return (
        counted(files, "files", F.lit("considered"))
        .unionByName(counted(files.join(with_days, "path", "left_anti"), "skipped_files",
                             F.lit("No daily numeric sheets found.")))
        .unionByName(counted(with_days, "files", F.lit("processed")))
        .unionByName(counted(rejected_sheets(headers), "sheet_failures", F.col("reason")))
        .unionByName(column_occurrences(headers).select(
            F.lit("column_occurrences").alias("section"),
            F.col("normalized_column_name").alias("name"), F.col("sheets").alias("count")))
    )

