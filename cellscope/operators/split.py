"""Exact-count, seeded splits.

Sizes follow the usual rule: test = ceil(n * test_share); in a stratified
split the train rows are allocated to classes by largest remainder (ties to
the lower class value) and each class gives its rows with the smallest
seeded keys to the held-out side. Class counts are collected (one row per
class); the key at the wanted count is found by ``ranking.take_smallest``, rows are not ranked.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEED, TEST_SHARE, VAL_SHARE
from ..functions.seeded import seeded_uniform
from ..session import materialize
from .ranking import take_smallest

log = logging.getLogger(__name__)


def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Per-class draws summing to ``n_draws`` by largest remainder."""
    total = sum(counts.values())
    keys = sorted(counts)
    cont = {k: counts[k] / total * n_draws for k in keys}
    out = {k: math.floor(cont[k]) for k in keys}
    need = n_draws - sum(out.values())
    for k in sorted(keys, key=lambda k: (-(cont[k] - math.floor(cont[k])), k))[:need]:
        out[k] += 1
    return out


def merge_features_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join on cell_id keeping label and composite_score."""
    return features.join(labels.select("cell_id", "label", "composite_score"), "cell_id")


def merge_row_loss(features: DataFrame, merged: DataFrame) -> DataFrame:
    """Q4: one-row check of rows lost by the merge."""
    a = features.agg(F.count(F.lit(1)).alias("n_features"))
    b = merged.agg(F.count(F.lit(1)).alias("n_merged"))
    return a.crossJoin(b).withColumn("rows_lost", F.col("n_features") - F.col("n_merged"))


def _held_out(df: DataFrame, n_out: dict, tag: str, label: str, key: str) -> DataFrame:
    """Flag ``_out`` on the n_out[c] rows of class c with the smallest keys."""
    spark = df.sparkSession
    quota = spark.createDataFrame([(k, int(v)) for k, v in n_out.items()], f"{label} {_sql_type(df, label)}, _q long")
    return take_smallest(df.withColumn("_u", seeded_uniform(tag, key)), "_u", quota, [label], key, "_out").drop("_u")


def _sql_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def stratified_split(dataset: DataFrame, label: str = "label", key: str = "cell_id",
                     test_share: float = TEST_SHARE, val_share: float = VAL_SHARE, seed: int = SEED) -> DataFrame:
    """Adds ``split`` in {train, val, test}; the second split uses
    val_share / (1 - test_share) of the remaining rows."""
    narrow = materialize(dataset.select(key, label), "split-keys")  # keys and labels, read by each selection
    counts = {r[label]: r["n"] for r in narrow.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    n_test = math.ceil(test_share * n)
    train_alloc = approximate_mode(counts, n - n_test)
    test_c = {k: counts[k] - train_alloc[k] for k in counts}
    first = _held_out(narrow, test_c, f"split-test-{seed}", label, key)
    rest_counts = {k: counts[k] - test_c[k] for k in counts}
    m = sum(rest_counts.values())
    adj = val_share / (1 - test_share)
    n_val = math.ceil(adj * m)
    tr2 = approximate_mode(rest_counts, m - n_val)
    val_c = {k: rest_counts[k] - tr2[k] for k in counts}
    test_rows = first.filter("_out").select(key, F.lit("test").alias("split"))
    second = _held_out(first.filter(~F.col("_out")).drop("_out"), val_c, f"split-val-{seed}", label, key)
    second = second.select(key, F.when(F.col("_out"), "val").otherwise("train").alias("split"))
    return dataset.join(materialize(test_rows.unionByName(second), "split-names"), key)


def random_split(dataset: DataFrame, key: str, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """M9: exactly ceil(n * test_share) test rows, chosen by seeded key."""
    quota = dataset.agg(F.ceil(F.count(F.lit(1)) * F.lit(float(test_share))).alias("_q"))
    out = take_smallest(dataset.withColumn("_u", seeded_uniform(f"split-{seed}", key)), "_u", quota, [], key, "_out")
    return out.withColumn("split", F.when(F.col("_out"), "test").otherwise("train")).drop("_u", "_out")


def validate_splits(split_df: DataFrame, original: DataFrame, label: str = "label") -> DataFrame:
    """Q3: sizes add up (fatal) and well-served shares of train vs val/test
    within 5 points (warning)."""
    per = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("share"))
    piv = per.agg(
        F.sum("n").alias("n_split"),
        F.max(F.when(F.col("split") == "train", F.col("share"))).alias("train_share"),
        F.max(F.when(F.col("split") == "val", F.col("share"))).alias("val_share"),
        F.max(F.when(F.col("split") == "test", F.col("share"))).alias("test_share"))
    orig = original.agg(F.count(F.lit(1)).alias("n_original"))
    out = piv.crossJoin(orig)
    return out.select(
        "n_original", "n_split", "train_share", "val_share", "test_share",
        (F.col("n_split") == F.col("n_original")).alias("is_valid"),
        ((F.abs(F.col("train_share") - F.col("val_share")) < 0.05)
         & (F.abs(F.col("train_share") - F.col("test_share")) < 0.05)).alias("balance_ok"))


def save_splits(split_df: DataFrame, path: str) -> None:
    """One dataset partitioned by split."""
    split_df.write.mode("overwrite").partitionBy("split").parquet(path)


def concat_splits(*parts: DataFrame) -> DataFrame:
    """UNION ALL by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
