"""Training runs stored once under what they were trained on, and reused by everything that serves them.

Two things are stored: whole runs, and the fitted models of each family, which runs with other sets
of families share. A name is a fingerprint of its configuration, the library version and the rows it trains on
(count and sum of row hashes, one aggregate, independent of order and files). Each is written to a
folder of its own and renamed into place when complete, so readers never see half a run; of two writers
of one run the first to rename wins and the other's copy is dropped.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark import __version__
from sensorspark.operators.models import ForecastBundle, ForecastConfig, reader
from sensorspark.plans import flows
from sensorspark.plans.shared import shared_folder

TABLES = ("coverage", "split_counts", "predictions", "metrics", "validation_leaderboard", "comparison")
LAYOUT = 1  # counts up when stored runs change their form


def dataset_fingerprint(df: DataFrame) -> dict:
    """Rows and an order-free hash of a table."""
    columns = sorted(df.columns)
    # Maps cannot be hashed; their sorted entries can.
    values = [F.array_sort(F.map_entries(f"`{c}`")) if dict(df.dtypes)[c].startswith("map") else F.col(f"`{c}`") for c in columns]
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*values).cast("decimal(38,0)")).alias("hash")).first()
    return {"rows": row["rows"], "hash": str(row["hash"]), "columns": columns}


def run_name(config: ForecastConfig, dataset: dict, family: str | None = None) -> str:
    """Name of a run, or of the models of one family, which do not depend on the other families."""
    told = asdict(config)
    if family:
        told.pop("families")
        told.pop("choose_on")
    parts = json.dumps([LAYOUT, __version__, family, told, dataset], sort_keys=True, default=list)
    return hashlib.sha256(parts.encode()).hexdigest()[:32]


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write to a draft folder beside `path` and rename it into place; an earlier one stays."""
    parent, _, name = path.rpartition("/")
    draft = f"{parent}/.draft-{name}-{uuid.uuid4().hex}"
    write(draft)
    files, source = _files(spark, draft)
    _, final = _files(spark, path)
    if files.exists(final) or not files.rename(source, final):
        files.delete(source, True)


def _write(trained: flows.Trained, path: str) -> None:
    trained.bundle.save(f"{path}/bundle")
    for name in TABLES:
        getattr(trained, name).write.parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> flows.Trained:
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in TABLES}
    return flows.Trained(ForecastBundle.load(spark, f"{path}/bundle"), **tables)


def _keeper(spark: SparkSession, store: str, config: ForecastConfig, dataset: dict):
    """Models of a family from the store, trained and stored first where they are missing."""
    def keep(family: str, names: Sequence[str], train: Callable[[], dict[str, object]]) -> dict[str, object]:
        path = f"{store}/models/{run_name(config, dataset, family)}"
        files, final = _files(spark, path)
        if not files.exists(final):
            models = train()
            _publish(spark, path, lambda draft: [m.save(f"{draft}/{n}") for n, m in models.items()])
            return models
        return {n: reader(family).load(f"{path}/{n}") for n in names}
    return keep


def trained(df: DataFrame, config: ForecastConfig, folder: str | None = None) -> flows.Trained:
    """The run of `config` on `df`: read from the store, or trained and stored first."""
    spark = df.sparkSession
    dataset = dataset_fingerprint(df)
    store = folder or f"{shared_folder(spark)}/forecasters"
    path = f"{store}/runs/{run_name(config, dataset)}"
    files, final = _files(spark, path)
    if not files.exists(final):
        run = flows.train(df, config, _keeper(spark, store, config, dataset))
        run.bundle.metadata["dataset"] = dataset
        run.bundle.metadata["trained_at"] = dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
        _publish(spark, path, lambda draft: _write(run, draft))
    return load(spark, path)
