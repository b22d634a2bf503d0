"""Table sinks and readers of the pipeline's outputs.

All writes go through Spark writers (overwrite, snappy Parquet or CSV with
header); nothing is collected to the driver to be written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.census import require_columns


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, overwrite; geometry kept as bbox / ring columns."""
    w = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_grid(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    require_columns(df, ["cell_id", "lat_min", "lat_max", "lon_min", "lon_max"], "grid")
    return df


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Features with the normalized columns the labeller needs (P5)."""
    df = spark.read.parquet(path)
    require_columns(df, ["cell_id", "stop_count_norm", "route_count_norm", "daily_trips_norm"], "features")
    return df


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    require_columns(df, ["cell_id", "label"], "labels")
    return df


def save_csv(df: DataFrame, path: str) -> None:
    """Metrics / importance tables as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_matrix(df: DataFrame, cols: list[str], path: str, names_path: str | None = None) -> None:
    """A feature matrix as Parquet with one array column, plus the
    feature names as CSV."""
    df.select(*[c for c in ("cell_id", "label") if c in df.columns],
              F.array(*[F.col(c).cast("double") for c in cols]).alias("x")).write.mode("overwrite").parquet(path)
    if names_path:
        spark = df.sparkSession
        spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "position int, feature string") \
            .coalesce(1).write.mode("overwrite").option("header", True).csv(names_path)
