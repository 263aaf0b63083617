"""Base load, feature choice and chronological split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark import constants as K
from sensorspark.functions.numeric import finite, plausible, to_double
from sensorspark.functions.times import coerce_datetime, ntz, round_to


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError("Missing required columns: " + ", ".join(missing))


def rename_aliases(df: DataFrame) -> DataFrame:
    """Accept the usual spellings of sensor columns in any case."""
    return df.toDF(*[K.COLUMN_ALIASES.get(c.lower(), c) for c in df.columns])


def sensor_columns(df: DataFrame) -> list[str]:
    return [c for c in K.SENSORS if c in df.columns]


def base_load(df: DataFrame, granularity: str, min_date: str | None = K.MIN_DATE,
              max_date: str | None = None) -> DataFrame:
    """Rows of one granularity in a date range, on the step, with implausible readings removed.

    The filters are plain comparisons on stored columns, so they reach the
    partition pruning and the file scan.
    """
    require_columns(df, ["region", "granularity", "date_time"])
    types = dict(df.dtypes)
    if types["date_time"] == "string":
        df = df.withColumn("date_time", coerce_datetime(F.col("date_time")))
    keep = (F.col("granularity") == granularity) & F.col("date_time").isNotNull()
    if min_date:
        keep = keep & (F.col("date_time") >= ntz(min_date))
    if max_date:
        keep = keep & (F.col("date_time") <= ntz(max_date))

    def reading(c: str) -> Column:
        col = F.col(c)
        if types[c] == "string":
            return plausible(to_double(col))
        return plausible(finite(col.cast("double")))

    return df.where(keep).withColumns({
        "date_time": round_to(F.col("date_time"), K.STEP_SECONDS[granularity]),
        **{c: reading(c) for c in sensor_columns(df)},
    })


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def remove_implausible(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Same rule as `plausible`, as SQL text: hundreds of columns are built in one call."""
    wanted, limit = set(columns), f"{K.IMPOSSIBLE_MAGNITUDE}D"
    return df.selectExpr(*[
        f"CASE WHEN abs(`{c}`) < {limit} THEN `{c}` END AS `{c}`" if c in wanted else f"`{c}`" for c in df.columns])


def feature_columns(df: DataFrame, targets: Sequence[str] = K.TARGETS) -> list[str]:
    """Numeric columns that are neither keys, lineage, flags nor targets, in table order."""
    excluded = {*K.NON_FEATURE_COLUMNS, *[f"target_{t}" for t in targets]}
    return [f.name for f in df.schema.fields
            if f.name not in excluded and isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def non_null_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at least one value. One aggregate for all columns."""
    columns = list(columns)
    if not columns:
        return []
    counts = df.agg(*[F.count(F.col(f"`{c}`")) for c in columns]).first()
    return [c for c, n in zip(columns, counts) if n]


def split_label(targets: Sequence[str] = K.TARGETS, train_end: str = K.TRAIN_END,
                validation_end: str = K.VALIDATION_END, ts: str = "date_time") -> Column:
    """train, validation or test by time; NULL unless this row, the next row and all targets were observed."""
    usable = (F.col("observed_row") == 1) & (F.col("observed_future") == 1)
    for t in targets:
        usable = usable & F.col(f"target_{t}").isNotNull()
    time = F.col(ts)
    return F.when(
        usable,
        F.when(time <= ntz(train_end), F.lit("train"))
        .when(time <= ntz(validation_end), F.lit("validation"))
        .when(time > ntz(validation_end), F.lit("test")),
    )


def split_counts(df: DataFrame, split: str = "split", region: str = "region") -> DataFrame:
    """Rows per split and region, with the split totals as rows whose region is NULL."""
    return df.where(F.col(split).isNotNull()).groupingSets(
        [[F.col(split), F.col(region)], [F.col(split)]], F.col(split), F.col(region),
    ).agg(F.count(F.lit(1)).alias("rows"), F.grouping(F.col(region)).alias("is_total"))


def require_splits(counts: DataFrame, split: str = "split") -> dict[str, int]:
    """Totals per split; an empty split is an error."""
    found = {r[split]: r["rows"] for r in counts.where("is_total = 1").collect()}
    totals = {name: found.get(name, 0) for name in ("train", "validation", "test")}
    if not all(totals.values()):
        raise ValueError(f"At least one split is empty: {totals}")
    return totals
