"""Row-frame windows over long series without one task per series.

`PARTITION BY region ORDER BY time` puts a whole station into one task, however
large it is. Here every series is cut into chunks of bounded size and each chunk
also gets the few rows before (and after) it that its frames reach into. The
windows then run per (region, chunk) and the borrowed rows are dropped, which
gives the same values as the plain window.

Two ways to cut:

* `step` given: the rows lie on a regular grid, so a distance in rows is a
  distance in time and the chunk follows from the timestamp alone.
* no `step`: rows are irregular. A first light pass counts the rows per
  (region, bucket of time); running sums of that small table tell which buckets
  make up a chunk and which earlier buckets it has to borrow. A bucket is never
  split, so it must be short enough to hold few rows; with one row per region
  and timestamp a day holds at most 86400 / step rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sensorspark.functions.times import seconds

ROWS_PER_CHUNK = 8192
_CHUNK, _OWN, _NEW = "_chunk", "_own", "_new_"


def _grid_chunks(df: DataFrame, ts: str, step: int, back: int, ahead: int, rows: int) -> DataFrame:
    rows = max(rows, back, ahead, 1)
    width = F.lit(rows * step)
    sec = seconds(F.col(ts))
    rest = F.pmod(sec, width)
    number = ((sec - rest) / width).cast("bigint")
    targets = [F.struct(number.alias(_CHUNK), F.lit(True).alias(_OWN))]
    if back:
        late = rest >= F.lit((rows - back) * step)
        targets.append(F.when(late, F.struct((number + 1).alias(_CHUNK), F.lit(False).alias(_OWN))))
    if ahead:
        early = rest < F.lit(ahead * step)
        targets.append(F.when(early, F.struct((number - 1).alias(_CHUNK), F.lit(False).alias(_OWN))))
    return df.select("*", F.inline(F.array_compact(F.array(*targets))))


def _chunk_plan(df: DataFrame, region: str, ts: str, bucket: int, back: int, ahead: int, rows: int) -> DataFrame:
    """(region, bucket) -> chunks that need the bucket. Small: one row per region and bucket."""
    rows = max(rows, back, ahead, 1)
    counts = (
        df.groupBy(F.col(region).alias("_r"), _bucket_of(ts, bucket).alias("_b"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # The frames below hold one row per region and bucket of time, never data rows.
    up = Window.partitionBy("_r").orderBy(F.col("_b").asc_nulls_last())
    down = Window.partitionBy("_r").orderBy(F.col("_b").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    so_far = up.rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.withColumn("_end", F.sum("_n").over(so_far)).withColumn("_start", F.col("_end") - F.col("_n"))
    spans = spans.withColumn("_c", F.floor(F.col("_start") / rows).cast("bigint"))
    # First bucket of each chunk; chunk numbers may skip, so neighbours are looked up.
    spans = spans.withColumn("_opens", ~F.col("_c").eqNullSafe(F.lag("_c").over(up)))

    def opening(column: Column | str, window: WindowSpec) -> Column:
        return F.last(F.when(F.col("_opens"), column), True).over(window)

    targets = [F.struct(F.col("_c").alias(_CHUNK), F.lit(True).alias(_OWN))]

    def borrow(condition: Column, chunk: str) -> None:
        targets.append(F.when(condition, F.struct(F.col(chunk).alias(_CHUNK), F.lit(False).alias(_OWN))))

    # Two neighbouring chunks span more than `rows` rows, so a bucket can reach
    # the next two chunks and the two before it, not further.
    if back:
        spans = spans.withColumns({"_next1": opening(F.col("_c"), down), "_from1": opening(F.col("_start"), down)})
        spans = spans.withColumns({"_next2": opening(F.col("_next1"), down), "_from2": opening(F.col("_from1"), down)})
        for k in (1, 2):
            borrow(F.col(f"_from{k}") - F.col("_end") < back, f"_next{k}")
    if ahead:
        spans = spans.withColumns({"_before": F.lag("_c").over(up), "_to1": opening(F.col("_start"), so_far)})
        spans = spans.withColumn("_prev1", opening(F.col("_before"), so_far))
        spans = spans.withColumns({"_before2": F.lag("_prev1").over(up), "_to1_before": F.lag("_to1").over(up)})
        spans = spans.withColumns({"_prev2": opening(F.col("_before2"), so_far), "_to2": opening(F.col("_to1_before"), so_far)})
        for k in (1, 2):
            borrow(F.col(f"_prev{k}").isNotNull() & (F.col("_start") - F.col(f"_to{k}") < ahead), f"_prev{k}")
    return spans.select("_r", "_b", F.array_compact(F.array(*targets)).alias("_targets"))


def _bucket_of(ts: str, width: int) -> Column:
    return F.floor(seconds(F.col(ts)) / F.lit(width)).cast("bigint")


def _row_chunks(df: DataFrame, region: str, ts: str, bucket: int, back: int, ahead: int, rows: int) -> DataFrame:
    plan = _chunk_plan(df, region, ts, bucket, back, ahead, rows)
    marked = df.withColumn("_bucket", _bucket_of(ts, bucket))
    on = F.col(region).eqNullSafe(F.col("_r")) & F.col("_bucket").eqNullSafe(F.col("_b"))
    return marked.join(plan, on).select("*", F.inline("_targets")).drop("_bucket", "_r", "_b", "_targets")


def over_series(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    *,
    region: str | None = "region",
    ts: str = "date_time",
    order: Sequence[str] = (),
    back: int = 0,
    ahead: int = 0,
    step: int | None = None,
    bucket: int = 86_400,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add the window columns `build(window)` to df.

    `back` and `ahead` are the largest distances in rows that the frames reach.
    `order` names tie-breakers after the timestamp.
    """
    out = df
    if region is None:
        out, region = out.withColumn("_all", F.lit(1)), "_all"
    if step is None:
        cut = _row_chunks(out, region, ts, bucket, back, ahead, rows_per_chunk)
    else:
        cut = _grid_chunks(out, ts, step, back, ahead, rows_per_chunk)
    keys = [F.col(ts).asc_nulls_last(), *[F.col(c) for c in order]]
    window = Window.partitionBy(region, _CHUNK).orderBy(*keys)
    added = build(window)
    # Columns of the same name are replaced by the window column.
    base = cut.select("*", *[c.alias(_NEW + name) for name, c in added.items()]).where(_OWN)
    if region == "_all":
        base = base.drop(region)
    base = base.drop(_CHUNK, _OWN, *[name for name in added if name in df.columns])
    return base.withColumnsRenamed({_NEW + name: name for name in added})


def previous_rows(window: WindowSpec, size: int) -> WindowSpec:
    """The `size` rows before the current one."""
    return window.rowsBetween(-size, -1)


def enough(col: Column | str, frame: WindowSpec, minimum: int) -> Column:
    """Does the frame hold that many non-null readings?"""
    return F.count(col).over(frame) >= minimum


def guarded(value: Column, col: Column, frame: WindowSpec, minimum: int) -> Column:
    """Window aggregate, only where the frame holds enough non-null readings."""
    return F.when(enough(col, frame, minimum), value.over(frame))
