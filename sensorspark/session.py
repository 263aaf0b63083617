"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "sensorspark", **settings: str) -> SparkSession:
    """Session with adaptive execution and a fixed zone. On a cluster leave `master` to the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Generated methods above this size are never compiled to machine code. Wide feature
        # selects then run as several smaller methods instead of one interpreted one.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
