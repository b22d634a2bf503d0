import numpy as np
from pyspark.sql import functions as F

from cellscope.operators import metrics as mt
from cellscope.operators.ranking import exact_quantiles, hash_rank
from cellscope.operators.split import approximate_mode, stratified_split


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 50, 3000), np.zeros(2000)]).astype(float)  # heavy tie at 0
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    ps = [0.0, 0.1, 0.5, 0.9, 0.95, 1.0]
    got = exact_quantiles(df, "x", ps).first()
    for i, p in enumerate(ps):
        assert abs(got[f"q{i}"] - np.quantile(vals, p)) < 1e-9


def test_hash_rank_is_a_permutation_and_partition_independent(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    df = df.withColumn("k", F.abs(F.hash("id")) / F.lit(2147483648.0))
    a = hash_rank(df.repartition(1), "k", ["g"], ["id"]).select("id", "_rank")
    b = hash_rank(df.repartition(17), "k", ["g"], ["id"]).select("id", "_rank")
    assert sorted(a.collect()) == sorted(b.collect())
    per = a.join(df, "id").groupBy("g").agg(F.min("_rank"), F.max("_rank"), F.count("*"), F.countDistinct("_rank"))
    for r in per.collect():
        assert r[1] == 0 and r[2] == r[3] - 1 and r[4] == r[3]


def test_split_sizes_golden():
    n = 20125
    import math
    n_test = math.ceil(0.15 * n)
    m = n - n_test
    n_val = math.ceil(0.15 / 0.85 * m)
    assert (n_test, n_val, m - n_val) == (3019, 3019, 14087)
    assert sum(approximate_mode({0: 8719, 1: 11406}, n - n_test).values()) == n - n_test


def test_stratified_split_exact_and_disjoint(spark):
    df = spark.range(2000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("cell_id"),
                                  (F.col("id") % 10 < 3).cast("int").alias("label"))
    s = stratified_split(df)
    sizes = dict(s.groupBy("split").count().collect())
    assert sizes == {"test": 300, "val": 300, "train": 1400}
    assert s.select("cell_id").distinct().count() == 2000
    shares = dict(s.groupBy("split").agg(F.avg("label")).collect())
    assert max(shares.values()) - min(shares.values()) < 0.01


def test_auc_equals_pair_count(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400), 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = mt.auc(df).first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - brute) < 1e-12


def test_confusion_completes_grid(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    got = {(r[0], r[1]): r[2] for r in mt.confusion(df).collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}
