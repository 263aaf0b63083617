"""Archives, folders and table files."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double
from sensorspark.operators.discovery import workbooks_only

_MEMBERS = "archive string, member_path string, content binary"
_UNSAFE = r"(^[/\\])|(^[A-Za-z]:)|(^|[/\\])\.\.([/\\]|$)"


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Zip files below a folder, one row per file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip") \
        .option("recursiveFileLookup", "true").load(folder)


def archive_members(archive_files: DataFrame) -> DataFrame:
    """One row per file inside every archive. The only Python on the batch path: the zip codec.

    Each task opens its own archives and streams one member at a time, so the
    memory of a task is bounded by one archive and one member.
    """
    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if not info.is_dir():
                            yield pd.DataFrame({"archive": [path], "member_path": [info.filename],
                                                "content": [archive.read(info)]})

    return archive_files.select("path", "content").mapInPandas(members, _MEMBERS)


def split_unsafe(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(safe, rejected with reason): members must stay below the target folder."""
    unsafe = F.col("member_path").rlike(_UNSAFE)
    rejected = members.where(unsafe).select(
        "archive", F.col("member_path").alias("path"),
        F.concat(F.lit("Unsafe zip member path: "), "member_path").alias("reason"))
    return members.where(~unsafe), rejected


def workbook_files(spark: SparkSession, folder: str) -> DataFrame:
    """Workbooks below a folder, lock files skipped. Other files are not opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!~]*.[xX][lL][sS]*")
    return workbooks_only(found.load(folder))


def parse_root_spec(spec: str) -> tuple[str | None, str]:
    """`REGION=path` or `path`."""
    region, sep, path = spec.partition("=")
    if not sep:
        return None, spec.strip().strip('"')
    return region.strip().upper(), path.strip().strip('"')


def child_roots(spark: SparkSession, folder: str) -> dict[str, str]:
    """Station folders directly below a raw folder, named by their paths."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(location)
    paths = sorted(f.getPath().toUri().getPath() for f in found if f.isDirectory())
    if not paths:
        raise ValueError(f"no station folders below {folder}")
    return {_region_of(path): path for path in paths}


def region_files(spark: SparkSession, roots: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Workbooks of several station folders with the station of each.

    `roots` maps stations to folders, or lists `REGION=path` specs; a root
    without a station is named by its path and a later root of the same station wins.
    """
    specs = list(roots.items()) if isinstance(roots, Mapping) else [parse_root_spec(s) for s in roots]
    named = {region or _region_of(path): path for region, path in specs}
    if not named:
        raise ValueError("no station folders given")
    parts = [workbook_files(spark, path).withColumn("region", F.lit(region))
             for region, path in sorted(named.items(), key=lambda item: _rank(item[0]))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _region_of(root: str) -> str:
    """Station named in a root folder, else an upper-case slug of its last part."""
    for region in K.REGIONS:
        if region.lower() in root.lower():
            return region
    stem = re.sub(r"(?<=.)\.[^.]+$", "", root.rstrip("/").rsplit("/", 1)[-1])
    return re.sub(r"[^a-z0-9]+", "_", stem.lower()).strip("_").upper()


def _rank(region: str) -> int:
    return K.REGIONS.index(region) if region in K.REGIONS else 99


COMBINED_SCHEMA = T.StructType(
    [T.StructField("region", T.StringType()), T.StructField("date_time", T.TimestampNTZType()),
     T.StructField("granularity", T.StringType())]
    + [T.StructField(n, T.IntegerType()) for n in ("year", "month", "day", "hour", "minute")]
    + [T.StructField(n, T.DoubleType()) for n in K.SENSORS]
    + [T.StructField(n, T.StringType()) for n in K.DESCRIPTION_COLUMNS]
    + [T.StructField("source_row_count", T.LongType()), T.StructField("source_file_count", T.LongType()),
       T.StructField("selected_row_non_null_score", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in K.LINEAGE_COLUMNS if n != "source_year"]
    + [T.StructField("source_year", T.IntegerType()), T.StructField("extra", T.MapType(T.StringType(), T.DoubleType()))]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, limit: int | None = None) -> DataFrame:
    """CSV with headers, typed by a declared schema; every file's columns are matched by its own header.

    Files may differ in the order and the number of their columns. A MAP<STRING, DOUBLE> column
    of the schema gathers the numbers of all columns that the schema does not name.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in wanted.fields}
    gathered = [n for n, kind in types.items() if isinstance(kind, T.MapType)]
    parts = []
    for header, files in sorted(_files_by_header(spark, path).items()):
        ordered = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])
        reader = spark.read.option("header", "true").schema(ordered)
        # Folder names like region=A below the path are columns too.
        df = (reader if re.search(r"[*?{\[]|\.[A-Za-z]+$", path) else reader.option("basePath", path)).csv(files)
        header = (*header, *[n for n in df.columns if n not in header])
        spare = [n for n in header if n not in types]
        pairs = F.map_filter(F.create_map(*[x for n in spare for x in (F.lit(n), to_double(F.col(f"`{n}`")))]),
                             lambda _, v: v.isNotNull()) if spare else F.create_map().cast("map<string,double>")
        parts.append(df.select(*[F.col(f"`{n}`") for n in header if n in types], *[pairs.alias(n) for n in gathered]))
    if not parts:
        return spark.createDataFrame([], wanted)
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part, allowMissingColumns=True)
    return df if limit is None else df.limit(limit)


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Data files below a path by the columns in their first line; one short row per file reaches the driver."""
    first = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).groupBy(
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file")).agg(F.first("value").alias("line"))
    parsed = first.select("file", F.split(F.regexp_replace("line", "^\ufeff|[\r\"]", ""), ",").alias("names"))
    out: dict[tuple[str, ...], list[str]] = {}
    for row in parsed.collect():
        out.setdefault(tuple(row["names"]), []).append(row["file"])
    return {header: sorted(files) for header, files in out.items()}


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, limit: int | None = None) -> DataFrame:
    """Same, but a path without files gives an empty table with the schema."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location)
    if not found:
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema, limit)


def flat_maps(df: DataFrame) -> DataFrame:
    """Map columns as one column per key, after the others; a key that is already a column keeps that column.

    Keys are header names of the sources, so there are about as many as a wide sheet has columns.
    """
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    out = [F.col(f"`{c}`") for c in df.columns if c not in maps]
    for name in maps:
        keys = df.select(F.explode(F.map_keys(F.col(f"`{name}`"))).alias("k")).distinct().orderBy("k").collect()
        out += [F.try_element_at(F.col(f"`{name}`"), F.lit(r["k"])).alias(r["k"]) for r in keys if r["k"] not in df.columns]
    return df.select(*out)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """Write a table as parquet, CSV (with header) or JSON.

    Partitioned tables are first clustered by the partition columns, so no task
    writes to every folder. REBALANCE lets adaptive execution split the share of
    a big station over many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if fmt == "csv":
        df = flat_maps(df)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)

