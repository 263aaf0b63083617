"""Which files are read: exclusions, exact copies and the reasons for every skip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.functions.text import exclusion_reason, is_workbook
from sensorspark.operators.joins import salted_lookup


def split_excluded(files: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with `reason`) by the path tokens."""
    marked = files.withColumn("reason", exclusion_reason(F.col(path)))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def workbooks_only(files: DataFrame, path: str = "path") -> DataFrame:
    return files.where(is_workbook(F.col(path)))


def content_key(files: DataFrame, content: str = "content") -> DataFrame:
    """Add the digest of the content, unless the table already carries it."""
    if "content_md5" in files.columns:
        return files
    return files.withColumn("content_md5", F.md5(F.col(content)))


def kept_files(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """One row per distinct content: the lowest path without regard to case, and the number of copies.

    Works on the digest, so contents are never shuffled, and aggregates on the
    map side, so a content with very many copies stays cheap.
    """
    keyed = content_key(files, content).select("content_md5", path)
    first = F.min(F.struct(F.lower(path).alias("_low"), F.col(path).alias("_path")))
    return keyed.groupBy("content_md5").agg(first.alias("_first"), F.count(F.lit(1)).alias("copies")).select(
        "content_md5", F.col("_first")["_path"].alias("kept_path"), "copies")


def duplicate_files(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Every file that repeats the content of a kept one, with the kept path as reason.

    The table is read three times; hand in stored digests (`content_key`) so that
    contents are read once.
    """
    keyed = content_key(files, content).select("content_md5", path)
    kept = kept_files(files, path, content)
    repeated = kept.where("copies > 1").drop("copies")
    sizes = kept.select("content_md5", F.col("copies").alias("rows"))
    return (
        salted_lookup(keyed, repeated, ["content_md5"], sizes)
        .where(F.col(path) != F.col("kept_path"))
        .select(path, F.concat(F.lit("Exact duplicate of "), "kept_path").alias("reason"))
    )


def unique_files(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Files to read, contents included: only the kept path of each content."""
    kept = kept_files(files, path, content).select(F.col("kept_path").alias(path))
    return files.join(kept, path, "left_semi")


def skip_report(*rejects: DataFrame) -> DataFrame:
    """Skipped files per reason over any number of reject tables (`path`, `reason`)."""
    out = rejects[0].select("path", "reason")
    for more in rejects[1:]:
        out = out.unionByName(more.select("path", "reason"))
    return out.groupBy("reason").agg(F.count(F.lit(1)).alias("files"))
