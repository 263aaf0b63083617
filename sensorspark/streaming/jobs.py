"""Stream scoring, stream clean-up and stream alerts.

Times are TIMESTAMP_NTZ at both ends. Watermarks need TIMESTAMP, so inside a
stateful step the wall clock is carried as if it were UTC.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorspark import constants as K
from sensorspark.functions.numeric import non_null_score
from sensorspark.functions.requests import violations
from sensorspark.functions.rules import rule_forecast
from sensorspark.functions.times import align_to_granularity, from_micros, micros
from sensorspark.operators.alerts import rolling_zscore_alerts
from sensorspark.operators.evaluate import last_rows
from sensorspark.operators.models import ForecastBundle, spread
from sensorspark.plans.flows import checked_requests, present_forecast, score


def _event_time(ts: Column) -> Column:
    return F.timestamp_micros(micros(ts))


def _wall_clock(ts: Column) -> Column:
    return from_micros(F.unix_micros(ts))


def score_stream(readings: DataFrame) -> DataFrame:
    """Range checks, rule-based forecast, risk and alerts of every arriving reading. Stateless."""
    checked = readings.withColumn("violations", violations(readings))
    values = {c: F.col(c) if c in readings.columns else F.lit(K.READING_DEFAULTS.get(c)).cast("double")
              for c in K.SENSORS}
    forecast = rule_forecast(F.col("region"), values, F.hour("date_time"), F.month("date_time"))
    out = checked.withColumns({f"{t}_forecast": c for t, c in forecast.items()})
    return present_forecast(out, {t: F.col(f"{t}_forecast") for t in K.TARGETS})


def clean_stream(raw: DataFrame, metrics: Sequence[str], delay: str = "1 hour", ties: Sequence[str] = ()) -> DataFrame:
    """One row per (region, granularity, rounded time): the row with the most readings.

    A key is given out once the watermark has passed it; rows later than `delay`
    are dropped. The state holds one row per open key, however many rows arrive.
    """
    rounded = align_to_granularity(F.col("date_time"), F.col("granularity"))
    score = non_null_score(*[F.col(c) for c in metrics])
    best = F.min(F.struct((-score).alias("_worse"), *[F.col(c) for c in ties], *[
        F.col(c) for c in metrics if c not in ties]))
    merged = (
        raw.where(F.col("date_time").isNotNull())
        .withColumn("_time", _event_time(rounded)).withWatermark("_time", delay)
        .groupBy("region", "granularity", "_time")
        .agg(best.alias("_best"), F.count(F.lit(1)).alias("source_row_count"))
    )
    return merged.select(
        "region", "granularity", _wall_clock(F.col("_time")).alias("date_time"), "source_row_count",
        (-F.col("_best")["_worse"]).alias("selected_row_non_null_score"),
        *[F.col("_best")[c].alias(c) for c in dict.fromkeys([*ties, *metrics])],
    )


def mean_stream(raw: DataFrame, metrics: Sequence[str], granularity: str = "hourly", delay: str = "1 hour") -> DataFrame:
    """Mean readings per region and step, given out once the watermark has passed the step."""
    step = K.STEP_SECONDS[granularity]
    return (
        raw.where(F.col("date_time").isNotNull())
        .withColumn("_time", _event_time(F.col("date_time"))).withWatermark("_time", delay)
        .groupBy("region", F.window("_time", f"{step} seconds").alias("_window"))
        .agg(*[F.avg(c).alias(c) for c in metrics])
        .select("region", _wall_clock(F.col("_window")["start"]).alias("date_time"), *metrics)
    )

def last_position(spark: SparkSession, checkpoint: str) -> tuple[int, int | None]:
    """(number, watermark in microseconds) of the last micro-batch of a stream that has ended; (-1, None) before the first."""
    log = spark.read.text(f"{checkpoint}/offsets").select(
        F.col("_metadata.file_name").cast("bigint").alias("batch"),
        F.get_json_object("value", "$.batchWatermarkMs").cast("bigint").alias("mark"))
    row = log.agg(F.max("batch").alias("batch"), F.max("mark").alias("mark")).first()
    return (-1, None) if row["batch"] is None else (row["batch"], None if row["mark"] is None else row["mark"] * 1000)


def still_open(whole: DataFrame, checkpoint: str, seconds: int = 0) -> DataFrame:
    """Rows of a step that the ended stream holds in its state, from the batch result `whole` of the same step.

    A row is open until the watermark has reached its time, or for windows of `seconds` their end. No row of an
    open key was late, so the batch rows past the watermark are those of the state. The state stays as it
    is: a later run gives these keys out itself, with what has arrived by then.
    """
    _, mark = last_position(whole.sparkSession, checkpoint)
    return whole if mark is None else whole.where(micros(F.col("date_time")) + F.lit(seconds * 1_000_000) > F.lit(mark))


class BatchFiles:
    """Working tables of a job, one folder per kind and micro-batch; repeating a batch overwrites its folders."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/{kind}/batch={batch_id}"

    def _folder(self, path: str):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration()), location

    def _exists(self, path: str) -> bool:
        files, location = self._folder(path)
        return files.exists(location)

    def _drop(self, kind: str, batch_id: int) -> None:
        if batch_id >= 0:
            files, location = self._folder(self._path(kind, batch_id))
            files.delete(location, True)

    def _last(self, kind: str) -> int:
        """Number of the last micro-batch that has files of a kind, -1 without any."""
        files, location = self._folder(f"{self.folder}/{kind}")
        if not files.exists(location):
            return -1
        return max((int(s.getPath().getName().removeprefix("batch=")) for s in files.listStatus(location)
                    if s.getPath().getName().startswith("batch=")), default=-1)

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (
            stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).foreachBatch(self.process).start()
        )


class RollingAlertJob(BatchFiles):
    """Rolling z-score alerts on a stream with the batch operator.

    Each micro-batch is stored once, joined to the last `window` rows per region
    of the batches before it, and run through the batch operator; so a big
    region is cut into chunks as in batch. All files of a batch carry its number
    and are overwritten when the batch is repeated, which makes a restart safe.
    Rows that are not newer than the last row of their region go to `late`.
    """

    def __init__(self, spark: SparkSession, folder: str, pollutants: Sequence[str], window: int = 24,
                 threshold: float = 3.0) -> None:
        super().__init__(spark, folder)
        self.pollutants, self.window, self.threshold = list(pollutants), window, threshold

    def _forget(self, batch_id: int) -> None:
        """Drop working files that no repeat can ask for: a batch only runs once the one before is committed."""
        self._drop("rows", batch_id - 1)
        self._drop("tail", batch_id - 2)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        columns = ["region", "date_time", *self.pollutants]
        batch.select(*columns).write.mode("overwrite").parquet(self._path("rows", batch_id))
        rows = self.spark.read.schema(batch.select(*columns).schema).parquet(self._path("rows", batch_id))
        fresh, history = rows.withColumn("_fresh", F.lit(1)), None
        if batch_id > 0 and self._exists(self._path("tail", batch_id - 1)):
            history = self.spark.read.parquet(self._path("tail", batch_id - 1))
            ends = history.groupBy("region").agg(F.max("date_time").alias("_end"))
            dated = rows.join(ends, "region", "left")
            late = F.coalesce(F.col("date_time") <= F.col("_end"), F.lit(False))
            dated.where(late).drop("_end").write.mode("overwrite").parquet(self._path("late", batch_id))
            fresh = dated.where(~late).drop("_end").withColumn("_fresh", F.lit(1))
        known = fresh if history is None else history.withColumn("_fresh", F.lit(0)).unionByName(fresh)
        alerts = rolling_zscore_alerts(known, self.pollutants, self.window, self.threshold, order=["_fresh"])
        alerts.where("_fresh = 1").drop("_fresh").write.mode("overwrite").parquet(self._path("alerts", batch_id))
        last_rows(known, self.window, order=["_fresh"]).drop("_fresh") \
            .write.mode("overwrite").parquet(self._path("tail", batch_id))
        self._forget(batch_id)

    def finish(self, whole: DataFrame, checkpoint: str, seconds: int = 0) -> None:
        """Alerts of the rows still open when the stream ended, as the batch after its last.

        A later run of the stream overwrites them under the same number.
        """
        number, _ = last_position(self.spark, checkpoint)
        self.process(still_open(whole, checkpoint, seconds), number + 1)

    def alerts(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.folder}/alerts").parquet(f"{self.folder}/alerts").drop("batch")


class CleanJob(BatchFiles):
    """Best row per (region, granularity, rounded time) of a stream, with its late rows kept apart.

    State is a table: the keys still open, one row each, however many rows of a key arrive. A micro-batch is
    aggregated before it meets the state, so a key with most of the rows costs one row per task. The watermark is
    the greatest key time of the batches before, less `delay` seconds. Keys it has passed are closed and never
    change; rows that come after that go to the late table as they are. Every micro-batch is read once.

    `closed`, `open` and `late` can be read at any time between batches; a later run goes on from the same state.
    """

    KEYS = ("region", "granularity", "_time")

    def __init__(self, spark: SparkSession, folder: str, metrics: Sequence[str], delay: int = 3600,
                 ties: Sequence[str] = ()) -> None:
        super().__init__(spark, folder)
        self.metrics, self.delay, self.ties = list(metrics), delay, list(ties)

    def _mark(self, batch_id: int) -> int | None:
        """Watermark, in microseconds, after a batch."""
        if batch_id < 0 or not self._exists(self._path("seen", batch_id)):
            return None
        seen = self.spark.read.parquet(self._path("seen", batch_id)).first()["seen"]
        return None if seen is None else seen - self.delay * 1_000_000

    def _keys(self, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(self._path("keys", batch_id))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        rounded = align_to_granularity(F.col("date_time"), F.col("granularity"))
        rows = batch.where(F.col("date_time").isNotNull()).withColumn("_time", micros(rounded))
        mark = self._mark(batch_id - 1)
        late = F.lit(False) if mark is None else F.col("_time") <= mark
        seen = Observation()
        stored = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            timely = stored.observe(seen, F.max("_time").alias("last"), F.count_if(late).alias("late")).where(~late)
            score = non_null_score(*[F.col(c) for c in self.metrics])
            best = F.min(F.struct((-score).alias("_worse"), *[F.col(c) for c in self.ties], *[
                F.col(c) for c in self.metrics if c not in self.ties]))
            keys = timely.groupBy(*self.KEYS).agg(best.alias("_best"), F.count(F.lit(1)).alias("source_row_count"))
            if batch_id > 0:
                held = self._keys(batch_id - 1)
                held = held if mark is None else held.where(F.col("_time") > mark)
                keys = keys.unionByName(held).groupBy(*self.KEYS).agg(
                    F.min("_best").alias("_best"), F.sum("source_row_count").alias("source_row_count"))
            keys.write.mode("overwrite").parquet(self._path("keys", batch_id))
            found = seen.get
            if found["late"]:
                stored.where(late).drop("_time").write.mode("overwrite").parquet(self._path("late", batch_id))
        finally:
            stored.unpersist()
        times = [t for t in (found["last"], None if mark is None else mark + self.delay * 1_000_000) if t is not None]
        self.spark.createDataFrame([(max(times, default=None),)], "seen bigint").coalesce(1) \
            .write.mode("overwrite").parquet(self._path("seen", batch_id))
        after = self._mark(batch_id)
        done = self._keys(batch_id).where(F.lit(False) if after is None else F.col("_time") <= after)
        done.write.mode("overwrite").parquet(self._path("closed", batch_id))
        self._drop("keys", batch_id - 2)
        self._drop("seen", batch_id - 2)

    def _shown(self, keys: DataFrame) -> DataFrame:
        return keys.select(
            "region", "granularity", from_micros(F.col("_time")).alias("date_time"), "source_row_count",
            (-F.col("_best")["_worse"]).alias("selected_row_non_null_score"),
            *[F.col("_best")[c].alias(c) for c in dict.fromkeys([*self.ties, *self.metrics])])

    def closed(self) -> DataFrame:
        """Keys the watermark has passed."""
        return self._shown(self.spark.read.option("basePath", f"{self.folder}/closed").parquet(f"{self.folder}/closed").drop("batch"))

    def open(self) -> DataFrame:
        """Keys that later rows may still change, as they stand."""
        last = self._last("keys")
        mark = self._mark(last)
        keys = self._keys(last)
        return self._shown(keys if mark is None else keys.where(F.col("_time") > mark))

    def late(self, schema) -> DataFrame:
        """Rows of `schema` that came after their key was closed."""
        if self._last("late") < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.folder}/late").schema(schema).parquet(f"{self.folder}/late")


class ModelScoringJob(BatchFiles):
    """Requests of a stream scored with a saved bundle: forecasts of the valid ones, the others with what is wrong with them.

    Both tables are written by the same micro-batch under its number, so a batch that is repeated changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, bundle: ForecastBundle, strategy: str = "best",
                 keep: Sequence[str] = ()) -> None:
        super().__init__(spark, folder)
        self.bundle, self.strategy, self.keep = bundle, strategy, tuple(keep)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        stored = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scored = score(self.bundle, spread(stored), self.strategy, self.keep)
            scored.write.mode("overwrite").parquet(self._path("scores", batch_id))
            _, rejected = checked_requests(stored)
            rejected.select(*self.keep, "region", "date_time", "violations").write.mode("overwrite").parquet(self._path("rejects", batch_id))
        finally:
            stored.unpersist()

    def _table(self, kind: str) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.folder}/{kind}").parquet(f"{self.folder}/{kind}").drop("batch")

    def scores(self) -> DataFrame:
        return self._table("scores")

    def rejects(self) -> DataFrame:
        return self._table("rejects")


def with_end(stream: DataFrame, folder: str, ts: str = "date_time") -> DataFrame:
    """A stream with a second source of end marks (see `mark_end`): rows in which only the time is set."""
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).coalesce(1).write.mode("append").parquet(f"{folder}/end")
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(f"{folder}/end"))


def mark_end(stream: DataFrame, folder: str, checkpoint: str, seconds: int, ts: str = "date_time") -> None:
    """End mark for a stream that has run: a time `seconds` past its watermark, so that the next run closes everything.

    `seconds` must cover twice the delay and the longest step. Rows that arrive after that run are late.
    """
    _, mark = last_position(stream.sparkSession, checkpoint)
    if mark is not None:
        row = {ts: mark + seconds * 1_000_000}
        columns = [from_micros(F.lit(row[f.name])).alias(f.name) if f.name in row else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in stream.schema.fields]
        stream.sparkSession.range(1).select(*columns).coalesce(1).write.mode("append").parquet(f"{folder}/end")


ALERTS = "date_time timestamp_ntz, region string, pollutant string, value double, z_score double"
_STATE = "hours array<struct<us: bigint, sums: array<double>, counts: array<bigint>>>, recent array<array<double>>, last_us bigint"


def _partial_sums(pollutants: Sequence[str]):
    """Sum and count per region and step of the rows of a task, so that a busy region sends few rows."""
    def run(frames):
        for frame in frames:
            grouped = frame.groupby(["region", "_us"], dropna=False)[list(pollutants)]
            sums, counts = grouped.sum(), grouped.count()
            out = sums.index.to_frame(index=False)
            out["region"] = out["region"].astype(object).where(out["region"].notna(), None)
            out["sums"], out["counts"] = sums.to_numpy().tolist(), counts.to_numpy().tolist()
            yield out
    return run


def _alerts_of_region(pollutants: Sequence[str], step_us: int, window: int, threshold: float, keep: int):
    """Alerts of one region. Its state is the steps still open and the last `window` closed ones.

    An event-time timer closes steps as the watermark passes their end; when none is open it drops
    the state `keep` seconds after the last one.
    """
    least = max(3, window // 4)
    columns = ["date_time", "region", "pollutant", "value", "z_score"]

    def closed(region, us, values, recent):
        for i, (name, value) in enumerate(zip(pollutants, values, strict=True)):
            known = [r[i] for r in recent if r[i] is not None]
            if value is None or len(known) < max(least, 2):
                continue
            spread, mean = float(np.std(known, ddof=1)), float(np.mean(known))
            if spread and abs(value - mean) / spread >= threshold:
                yield pd.Timestamp(us, unit="us"), region, name, value, (value - mean) / spread

    def run(key, frames, state):
        held, recent, last = state.get if state.exists else ([], [], None)
        hours = {h[0]: (list(h[1]), list(h[2])) for h in held}
        recent = [list(r) for r in recent]
        for frame in frames:
            for us, sums, counts in zip(frame["_us"], frame["sums"], frame["counts"], strict=True):
                old = hours.get(us, ([0.0] * len(pollutants), [0] * len(pollutants)))
                hours[int(us)] = tuple([a + b for a, b in zip(x, y, strict=True)] for x, y in zip(old, (sums, counts), strict=True))
        mark = state.getCurrentWatermarkMs()
        out = []
        for us in sorted(h for h in hours if (h + step_us) // 1000 <= mark):
            values = [s / n if n else None for s, n in zip(*hours.pop(us), strict=True)]
            out += closed(key[0], us, values, recent)
            recent, last = [*recent, values][-window:], us
        if not hours and state.hasTimedOut and not out and (last is None or last // 1000 + keep * 1000 <= mark):
            state.remove()
            return
        state.update(([(us, [float(s) for s in sums], [int(n) for n in counts]) for us, (sums, counts) in sorted(hours.items())], recent, last))
        due = (min(hours) + step_us) // 1000 - 1 if hours else (last or 0) // 1000 + keep * 1000
        state.setTimeoutTimestamp(max(due, mark + 1))
        if out:
            yield pd.DataFrame(out, columns=columns)
    return run


def stateful_alerts(raw: DataFrame, pollutants: Sequence[str], granularity: str = "hourly", window: int = 24, threshold: float = 3.0,
                    delay: str = "1 hour", keep_days: int = 30) -> DataFrame:
    """Rolling z-score alerts on the mean readings of every step, with keyed state and event-time timers.

    Rows of a task are added up by region and step before they are shuffled to the state of their region.
    Steps that end `delay` before the latest one are closed in order; rows of closed steps are dropped and show in the
    query's progress as dropped by the watermark. State of a region silent for `keep_days` is dropped. Rows
    without region, which end marks are, give no alerts. The result does not depend on how rows fall into micro-batches,
    unless they are late.
    """
    step = K.STEP_SECONDS[granularity] * 1_000_000
    start = micros(F.col("date_time")) - F.pmod(micros(F.col("date_time")), F.lit(step))
    slim = raw.where(F.col("date_time").isNotNull()).select("region", start.alias("_us"), *[F.col(c).cast("double").alias(c) for c in pollutants])
    sums = slim.mapInPandas(_partial_sums(list(pollutants)), "region string, _us bigint, sums array<double>, counts array<bigint>")
    timed = sums.withColumn("_end", F.timestamp_micros(F.col("_us") + step)).withWatermark("_end", delay)
    run = _alerts_of_region(list(pollutants), step, window, threshold, keep_days * 86400)
    named = F.coalesce("region", F.lit("")).alias("region")
    alerts = timed.select(named, "_us", "sums", "counts", "_end").groupBy("region").applyInPandasWithState(
        run, ALERTS, _STATE, "append", "EventTimeTimeout")
    return alerts.where("region <> ''")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> DataFrame:
    """Run a stream over everything that is available now and read the result back."""
    query = (
        stream.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files as a stream. The pattern also takes a path that is a single file."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(f"{path.rstrip('/')}*")
