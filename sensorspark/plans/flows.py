"""Prepare, train and score as whole flows over tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.alerts import spike_alerts
from sensorspark.functions.numeric import non_null_score
from sensorspark.functions.narrative import forecast_summary, importance_sentence
from sensorspark.functions.requests import reading_columns, violations
from sensorspark.functions.risk import risk_four_level
from sensorspark.functions.text import normalize_region
from sensorspark.functions.times import request_time
from sensorspark.operators import evaluate, features, merge, models, split
from sensorspark.plans.shared import materialize
from sensorspark.sources import sheets
from sensorspark.sources.files import flat_maps


@dataclass
class Prepared:
    """Tables of a prepare run."""

    combined: DataFrame
    rejected_sheets: DataFrame
    column_mapping: DataFrame
    diagnostics: DataFrame
    region_summary: DataFrame
    merge_report: DataFrame


def prepare(cells: DataFrame, root: str = "") -> Prepared:
    """Sheet cells to one clean row per (region, granularity, timestamp).

    Extra metrics stay in a map column, held as sorted entries while rows are compared.
    """
    headers = sheets.sheet_headers(cells)
    readings = merge.align_rows(sheets.load_sheets(cells, headers, root))
    entries = readings.withColumn("extra", F.array_sort(F.map_entries("extra")))
    metrics = merge.metric_columns(entries)
    # Extra readings count for the quality of a row as canonical ones do.
    score = non_null_score(*[F.col(c) for c in metrics if c != "extra"]) + F.size(
        F.filter("extra", lambda e: e["value"].isNotNull()))
    combined = merge.merge_duplicates(entries, metrics=metrics, score=score)
    combined = combined.withColumn("extra", F.map_from_entries("extra"))
    return Prepared(
        combined, sheets.rejected_sheets(headers), sheets.column_mapping(headers),
        sheets.ingest_diagnostics(cells, headers), merge.region_summary(combined), merge.merge_report(combined),
    )


@dataclass
class Trained:
    """Tables and models of a training run."""

    bundle: models.ForecastBundle
    coverage: DataFrame
    split_counts: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    validation_leaderboard: DataFrame
    comparison: DataFrame


def train(df: DataFrame, config: models.ForecastConfig | None = None, keep: models.Keep = models.fit_now) -> Trained:
    """Train and compare on a table of readings; `keep` may hand out models that were trained before."""
    config = config or models.ForecastConfig()
    # Stored once: the spine, the readings, the station names and the coverage all read it. Extra metrics become columns.
    base = materialize(split.base_load(flat_maps(df), config.granularity, config.min_date, config.max_date), "base")
    split.require_rows(base, f"No rows found for granularity {config.granularity!r}.")
    frame = materialize(models.model_frame(base, config), "model-frame")
    counts = split.split_counts(frame)
    totals = split.require_splits(counts)
    bundle, predictions, metrics = models.fit(frame, config, keep)
    bundle.metadata["split_counts"] = totals
    candidates = evaluate.overall(metrics).where(F.col("strategy") != models.BASELINE)
    return Trained(
        bundle, merge.region_coverage(base, config.targets), counts, predictions, metrics,
        evaluate.leaderboard(candidates, "validation"), evaluate.leaderboard(evaluate.overall(metrics), "test"),
    )


def checked_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with `violations`); valid rows get canonical readings, station and time."""
    named = requests
    bad = violations(requests.withColumn("region", normalize_region(F.col("region"))))
    readings = {name: col for name, col in reading_columns(requests, coalesce_nulls=True).items()}
    times = [F.col(c).cast("string") for c in ("date_time", "timestamp") if c in requests.columns]
    when = request_time(F.coalesce(*times) if times else F.lit(None).cast("string"))
    ready = named.withColumn("region", normalize_region(F.col("region"))).withColumn("violations", bad)
    ready = ready.withColumns({**readings, "date_time": when})
    unreadable = F.when(F.col("date_time").isNull(), F.array(F.lit("date_time"))).otherwise(F.array().cast("array<string>"))
    ready = ready.withColumn("violations", F.concat("violations", unreadable))
    valid = F.size("violations") == 0
    return ready.where(valid).drop("violations"), ready.where(~valid)


def present_forecast(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Risk, advice, sentence and alerts next to forecast columns."""
    risk = risk_four_level(*[values[t] for t in K.TARGETS])
    return df.withColumns({
        "risk": risk,
        "recommendation": risk["recommendation"],
        "summary": forecast_summary(values),
        "anomaly_alerts": spike_alerts(values),
    })


def score(bundle: models.ForecastBundle, requests: DataFrame, strategy: str = "best",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Forecast, risk and alerts of every valid request; works on batches and streams alike."""
    valid, _ = checked_requests(requests)
    rows = features.cold_start_features(valid, bundle.features, keep=("region", "date_time", *keep))
    scored = models.predict(bundle, rows, strategy)
    out = scored.select("region", "date_time", *keep, *[
        c for t in bundle.targets for c in (f"{t}_forecast", f"{t}_strategy")])
    values = {t: F.col(f"{t}_forecast") for t in K.TARGETS}
    return present_forecast(out, values).withColumns({
        "strategy": F.lit(strategy), "feature_count": F.lit(len(bundle.features)),
    })


def explained(spark: SparkSession, bundle: models.ForecastBundle, k: int = 5) -> DataFrame:
    """One row: the strongest features of the bundle and the sentence about them."""
    top = models.bundle_importance(spark, bundle, k)
    listed = top.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("importance")).alias("_order"), "position", "feature", "importance"))).alias("_top"))
    return listed.select(
        F.lit("feature_importance_fallback").alias("method"),
        F.transform("_top", lambda x: F.struct(x["feature"].alias("feature"), x["importance"].alias("importance"))).alias("top_features"),
        importance_sentence(F.transform("_top", lambda x: x["feature"])).alias("summary"),
    )


def to_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("json"))
