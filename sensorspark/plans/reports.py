"""Run reports as tables: metadata, contract, long report, compact rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark import __version__
from sensorspark import constants as K
from sensorspark.operators import evaluate
from sensorspark.operators.models import SCOPES, ForecastBundle

METADATA_SCHEMA = (
    "project string, version string, targets array<string>, feature_names array<string>, feature_count int, "
    "supported_regions array<string>, trained_at string, granularity string, model_dir string, strategies array<string>"
)


def serving_metadata(spark: SparkSession, bundle: ForecastBundle) -> DataFrame:
    meta = bundle.metadata
    row = ("sensorspark", __version__, bundle.targets, bundle.features, len(bundle.features), list(K.REGIONS),
           meta.get("trained_at", "unknown"), meta.get("granularity", "unknown"), meta.get("model_dir"),
           ["best", *SCOPES, *sorted(bundle.candidates())])
    return spark.createDataFrame([row], METADATA_SCHEMA)


def inference_contract(spark: SparkSession, bundle: ForecastBundle) -> DataFrame:
    row = (["region", *K.TARGETS], ["date_time", *[s for s in ("temp", "hum", "ws", "wd")],
           *[s for s in K.SENSORS if s not in (*K.TARGETS, "temp", "hum", "ws", "wd")]],
           bundle.targets, ["best", *SCOPES, *bundle.candidates()], len(bundle.features),
           bundle.metadata.get("regions", []))
    return spark.createDataFrame([row], (
        "required array<string>, optional array<string>, outputs array<string>, strategies array<string>, "
        "feature_count int, regions array<string>"))


def _section(df: DataFrame, name: str, key: Column) -> DataFrame:
    """Each row of a table as (section, key, value) with the value as JSON."""
    return df.select(F.lit(name).alias("section"), key.alias("key"), F.to_json(F.struct("*")).alias("value"))


def long_report(config: DataFrame, coverage: DataFrame, counts: DataFrame, metrics: DataFrame,
                best: DataFrame) -> DataFrame:
    """Run summary as one table: configuration, coverage, split sizes, metrics and winners."""
    test = evaluate.overall(metrics).where("split = 'test'")
    totals = counts.where("is_total = 1").select("split", "rows")
    regions = counts.where("is_total = 0").select("split", "region", "rows")
    return (
        _section(config, "configuration", F.lit("run"))
        .unionByName(_section(coverage, "coverage", F.col("region")))
        .unionByName(_section(totals, "split", F.col("split")))
        .unionByName(_section(regions, "split_by_region", F.concat_ws("/", "split", "region")))
        .unionByName(_section(test, "test_metrics", F.concat_ws("/", "strategy", "target")))
        .unionByName(_section(evaluate.target_leaderboard(test), "best_by_target", F.col("target")))
        .unionByName(_section(best, "best_by_region_target", F.concat_ws("/", "region", "target")))
    )


def compact_report(metrics: DataFrame) -> DataFrame:
    """One row rebuilt from stored metrics: targets, leaderboard and test metrics as nested columns.

    Metrics tables hold one row per strategy, split and target.
    """
    row = F.struct("target", "strategy", "rmse", "mae", "r2")
    per_strategy = metrics.where("split = 'test'").groupBy("strategy").agg(
        F.avg("rmse").alias("mean_rmse"), F.avg("mae").alias("mean_mae"), F.avg("r2").alias("mean_r2"),
        F.collect_list(row).alias("_rows"))
    rows = F.array_sort(F.flatten(F.collect_list("_rows")))
    return per_strategy.agg(
        F.array_sort(F.collect_list(F.struct("mean_rmse", "mean_mae", "strategy", "mean_r2"))).alias("model_comparison"),
        rows.alias("test_metrics"),
        F.array_sort(F.array_distinct(F.transform(rows, lambda r: r["target"]))).alias("targets"),
    )
