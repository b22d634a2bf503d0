"""Z-score and min-max scaling with statistics kept as one-row frames.

``fit`` returns a one-row DataFrame of statistics; ``transform`` cross-joins
it (broadcast, one row) so fitting stays lazy and distributed, and the same
statistics can be written out and reused on other data (``fit=False``).
The z-score uses the population standard deviation, with 0 replaced by 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import one_row


def fit_zscore(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def transform_zscore(df: DataFrame, stats: DataFrame, cols: list[str], suffix: str = "_norm") -> DataFrame:
    out = df.crossJoin(one_row(stats))
    for c in cols:
        scale = F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))
        out = out.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"{c}__mean")) / scale)
    return out.drop(*stats.columns)


def zscore(df: DataFrame, cols: list[str], suffix: str = "_norm", stats: DataFrame | None = None) -> DataFrame:
    """Fit (unless ``stats`` is given) and transform in one lazy plan."""
    return transform_zscore(df, stats if stats is not None else fit_zscore(df, cols), cols, suffix)


def normalize_features(features: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """M3: ``*_norm`` for stop_count, route_count, daily_trips."""
    return zscore(features, ["stop_count", "route_count", "daily_trips"], stats=stats)


def normalize_population(features: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """M4: ``population_norm``; the column is required."""
    if "population" not in features.columns:
        raise ValueError("Population column missing - merge census population first; "
                         f"available: {', '.join(features.columns)}")
    return zscore(features, ["population"], stats=stats)


def fit_minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return df.agg(*aggs)


def minmax(df: DataFrame, cols: list[str], suffix: str = "_mm", stats: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min), 0 when the column is constant."""
    stats = stats if stats is not None else fit_minmax(df, cols)
    out = df.crossJoin(one_row(stats))
    for c in cols:
        rng = F.col(f"{c}__max") - F.col(f"{c}__min")
        out = out.withColumn(f"{c}{suffix}", F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"{c}__min")) / rng))
    return out.drop(*stats.columns)
