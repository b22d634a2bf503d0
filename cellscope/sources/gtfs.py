"""Transit-feed sources and sinks.

A feed is a folder of CSV members such as ``stops.txt``, one zip archive of them, or a folder of archives. Folders are
read by Spark's CSV reader, archives by the data source in ``archive`` (a task for each archive and member). Ids are
text, as feeds write them: leading zeros and letters stay.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import archive

log = logging.getLogger(__name__)

# Declared schemas of the feed members the operators use.
SCHEMAS = {
    "stops": "stop_id string, stop_lat double, stop_lon double",
    "trips": "trip_id string, route_id string, service_id string",
    "stop_times": "trip_id string, stop_id string, stop_sequence int, arrival_time string",
    "calendar": ("service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, "
                 "saturday int, sunday int, start_date string, end_date string"),
}


def _is_archive(path: str) -> bool:
    """A zip archive, or a folder that is named for its archives (``.zips``)."""
    return path.lower().rstrip("/").endswith((".zip", ".zips"))


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """``.txt`` members of a feed (zip archive or folder) as (member)."""
    if not _is_archive(path):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path")
        return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("member")).orderBy("member")

    found = [(m,) for _, m, _ in archive.members(path)]
    return spark.createDataFrame(found, "member string").orderBy("member")


def _typed(df: DataFrame, schema: str | None) -> DataFrame:
    """Declared columns typed (null when absent or malformed, then named in ``_bad``), the others as text."""
    fields = T._parse_datatype_string(schema).fields if schema else []
    declared, wrong = [], []
    for f in fields:
        given = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast("string")
        declared.append(given.try_cast(f.dataType).alias(f.name))
        wrong.append(F.when((F.trim(given) != "") & given.try_cast(f.dataType).isNull(), F.lit(f.name)))
    names = {f.name for f in fields}
    bad = F.nullif(F.concat_ws(",", *wrong), F.lit("")) if wrong else F.lit(None).cast("string")
    return df.select(*declared, *[F.col(f"`{c}`") for c in df.columns if c not in names], bad.alias(archive.BAD))


def read_member(spark: SparkSession, path: str, name: str, schema: str | None = None, keep_bad: bool = False) -> DataFrame:
    """One member as a DataFrame, columns bound by header name.

    Declared columns are cast; columns that the schema does not name stay text. A value that does not fit becomes
    null; with ``keep_bad`` the column ``_bad`` names the columns of a record that did not fit.
    """
    schema = schema or SCHEMAS.get(name)
    if _is_archive(path):
        found = archive.read_archive(spark, path, name, schema)
    else:
        text = spark.read.option("header", True).csv(os.path.join(path, f"{name}.txt"))
        found = _typed(text.toDF(*[c.strip().lstrip("\ufeff") for c in text.columns]), schema)
    return found if keep_bad else found.drop(archive.BAD)


def bad_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(table, records, bad): records of each member and how many hold a value or a length that does not fit."""
    parts = [read_member(spark, path, n, keep_bad=True).agg(F.count(F.lit(1)).alias("records"), F.count(archive.BAD).alias("bad")).select(F.lit(n).alias("table"), "records", "bad") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_feed(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """S3: the members of the feed, all of them without ``names``; a missing one is logged and skipped."""
    there = list(dict.fromkeys(archive.base_name(r["member"]) for r in list_members(spark, path).collect()))
    wanted = names or there
    for name in wanted:
        if name not in there:
            log.warning("skipping %s: not in the feed", name)
    return {name: read_member(spark, path, name) for name in wanted if name in there}


def to_parquet(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Each table as snappy Parquet under ``out_dir/<name>.parquet``."""
    paths = {}
    for name, df in tables.items():
        p = os.path.join(out_dir, f"{name}.parquet")
        df.write.mode("overwrite").option("compression", "snappy").parquet(p)
        paths[name] = p
    return paths


def load_parquet(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table by name; a missing table raises FileNotFoundError."""
    p = os.path.join(base, f"{name}.parquet")
    try:
        return spark.read.parquet(p)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table '{name}' not found at {p}") from e
        raise


def load_data(spark: SparkSession, path: str) -> DataFrame:
    """Format chosen by suffix (csv, json as multi-line records, parquet)."""
    low = path.lower().rstrip("/")
    if low.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if low.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"no reader for {path}: expected csv, json or parquet")


def file_sizes(spark: SparkSession, source_dir: str, target_dir: str) -> DataFrame:
    """Bytes per table in the source (CSV members) and the Parquet copy,
    compression ratio (0 when no target), largest source first, plus a total
    row. File lengths come from ``binaryFile`` with the content column pruned."""
    def sizes(path, pattern, strip):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True) \
            .option("pathGlobFilter", pattern).load(path).select("path", "length")
        name = F.regexp_extract("path", strip, 1)
        return files.groupBy(name.alias("table")).agg(F.sum("length").alias("bytes"))

    src = sizes(source_dir, "*.txt", r"([^/]+)\.txt$").withColumnRenamed("bytes", "source_bytes")
    try:
        tgt = sizes(target_dir, "*.parquet", r"/([^/]+)\.parquet/[^/]+$").withColumnRenamed("bytes", "parquet_bytes")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        tgt = spark.createDataFrame([], "table string, parquet_bytes long")
    j = src.join(tgt, "table", "left").withColumn("parquet_bytes", F.coalesce("parquet_bytes", F.lit(0)))
    j = j.withColumn("ratio", F.when(F.col("parquet_bytes") > 0, F.col("source_bytes") / F.col("parquet_bytes"))
                     .otherwise(F.lit(0.0)))
    total = j.agg(F.lit("TOTAL").alias("table"), F.sum("source_bytes").alias("source_bytes"),
                  F.sum("parquet_bytes").alias("parquet_bytes")).withColumn(
        "ratio", F.when(F.col("parquet_bytes") > 0, F.col("source_bytes") / F.col("parquet_bytes"))
        .otherwise(F.lit(0.0)))
    return j.orderBy(F.desc("source_bytes")).unionByName(total)


def feed_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, column count and column list per table, most rows first."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("rows"), "table")
