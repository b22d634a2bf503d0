"""Dataset preparation: imputation, label encoding, engineered columns,
column selection helpers (M7, M8, C9-C11, P4, P5, P10, P13, U2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MODEL_EXCLUDED
from ..session import materialize
from .ranking import exact_quantiles, one_row

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """P10: numeric columns from the schema (no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NUMERIC)]


def feature_columns(df: DataFrame, excluded: list[str] = MODEL_EXCLUDED) -> list[str]:
    """Model inputs = numeric columns minus the excluded names and minus
    ``*_norm`` / ``*_normalized`` columns (labels are built from those)."""
    return [c for c in numeric_columns(df) if c not in excluded
            and not c.endswith("_norm") and not c.endswith("_normalized")]


def normalized_feature_columns(df: DataFrame) -> list[str]:
    """P4 variant: only ``*_norm`` / ``*_normalized`` columns."""
    return [c for c in numeric_columns(df) if c.endswith("_norm") or c.endswith("_normalized")]


def missing_and_extra(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """Expected names missing from ``df`` and extra names in it."""
    have = set(df.columns)
    return [c for c in expected if c not in have], sorted(have - set(expected))


def relabel(col, mapping: dict, default=None):
    """Value -> name through a ``when`` chain; ``col`` is a name or a column."""
    col = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


# ------------------------------------------------------------- imputation ---

def fit_imputer(df: DataFrame, strategy: str = "mean") -> dict:
    """Fill values per column with nulls (one aggregation pass + one exact
    median per numeric column when strategy='median').

    Numeric columns take the mean / median; other columns take the mode (the
    smallest of tied values). With strategy='mode' numeric nulls are kept.
    """
    if strategy not in ("mean", "median", "mode", "drop"):
        raise ValueError(f"unknown strategy {strategy}")
    if strategy == "drop":
        return {}
    nulls = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]).first().asDict()
    with_nulls = [c for c in df.columns if nulls[c]]
    num = set(numeric_columns(df))
    fills: dict = {}
    num_cols = [c for c in with_nulls if c in num]
    other = [c for c in with_nulls if c not in num]
    if num_cols and strategy == "mean":
        fills.update(df.agg(*[F.avg(c).alias(c) for c in num_cols]).first().asDict())
    if num_cols and strategy == "median":
        for c in num_cols:
            fills[c] = exact_quantiles(df, c, [0.5], ["m"]).first()["m"]
    for c in other:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        top = counts.orderBy(F.desc("_n"), F.asc(c)).limit(1).first()
        fills[c] = top[c] if top else None
    return fills


def impute(df: DataFrame, strategy: str = "mean", fills: dict | None = None) -> DataFrame:
    """M7: ``drop`` removes rows with any null; otherwise nulls take the
    fitted values. Numeric columns that are filled become double."""
    if strategy == "drop":
        return df.na.drop()
    fills = fit_imputer(df, strategy) if fills is None else fills
    num = set(numeric_columns(df))
    out = {}
    for c, v in fills.items():
        if v is None:
            continue
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v))) if c in num else F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(out) if out else df


# -------------------------------------------------------------- encoding ----

def fit_label_encoder(df: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """M8: sorted distinct values -> 0-based code, per column, as mapping
    frames (one row per category).

    The values stay distributed: they are dealt by range and written once, the
    rows of each range are numbered, and the counts of the ranges before it
    (one row per partition) are added.
    """
    maps = {}
    for c in columns:
        values = df.select(F.col(c).cast("string").alias(c)).where(F.col(c).isNotNull()).distinct()
        dealt = materialize(values.repartitionByRange(c).withColumn("_part", F.spark_partition_id()), "codes")
        sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
        place = F.row_number().over(Window.partitionBy("_part").orderBy(c)) - 1
        maps[c] = (dealt.withColumn("_place", place).join(starts, "_part")
                   .select(c, (F.col("_start") + F.col("_place")).cast("int").alias("code")))
    return maps


def label_encode(df: DataFrame, columns: list[str], maps: dict[str, DataFrame] | None = None) -> DataFrame:
    """Replace each column by its code; an unseen value raises (inner join
    row count check is avoided: the mapping join is validated lazily by
    ``assert_true``)."""
    maps = maps or fit_label_encoder(df, columns)
    out = df
    for c in columns:
        m = maps[c].withColumnRenamed("code", "_code")
        out = out.withColumn(c, F.col(c).cast("string")).join(m, c, "left")
        out = out.withColumn(c, F.when(F.col("_code").isNotNull(), F.col("_code"))
                             .otherwise(F.raise_error(F.concat(F.lit(f"unseen label in {c}: "),
                                                               F.coalesce(F.col(c), F.lit("null")))))
                             .cast("int")).drop("_code")
    return out.select(*df.columns)


# --------------------------------------------------- engineered columns -----

def polynomial_features(df: DataFrame, columns: list[str], degree: int = 2) -> DataFrame:
    """``{c}_pow_{d}`` for d = 2..degree."""
    return df.withColumns({f"{c}_pow_{d}": F.pow(F.col(c), float(d)) for c in columns for d in range(2, degree + 1)})


def interaction_features(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``{a}_x_{b}`` = a * b."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


def binned_feature(df: DataFrame, column: str, bins: int = 5, out: str | None = None) -> DataFrame:
    """C11: equal-width, right-closed bin code in 0..bins-1 (min in bin 0,
    null stays null). Edges are min + j * (max - min) / bins, the first edge
    lowered by 0.1% of the range; a constant column is widened by 0.1%."""
    out = out or f"{column}_binned"
    s = df.agg(F.min(column).cast("double").alias("_mn"), F.max(column).cast("double").alias("_mx"))
    same = F.col("_mn") == F.col("_mx")
    pad = F.when(F.col("_mn") != 0, F.abs(F.col("_mn")) * 0.001).otherwise(F.lit(0.001))
    s = s.select(F.when(same, F.col("_mn") - pad).otherwise(F.col("_mn")).alias("_lo"),
                 F.when(same, F.col("_mx") + pad).otherwise(F.col("_mx")).alias("_hi"))
    s = s.withColumn("_step", (F.col("_hi") - F.col("_lo")) / bins)
    x = F.col(column)
    code = sum((F.lit(j) * F.col("_step") + F.col("_lo") < x).cast("int") for j in range(1, bins))
    res = df.crossJoin(one_row(s)).withColumn(out, F.when(x.isNotNull(), code))
    return res.drop("_lo", "_hi", "_step")
