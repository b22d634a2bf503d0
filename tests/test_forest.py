import json
import types

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cellscope.operators import forest, ml
from cellscope.plans import q_ml

COLS = ["a", "b", "c", "d"]


def rows(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 7, n), rng.integers(0, 200, n)
    c = rng.random(n)
    y = (a / 7 + b / 200 + c + 0.5 * rng.standard_normal(n) > 1.5).astype(int)
    data = [(f"c{i:04d}", int(y[i]), float(a[i]), float(b[i]), float(c[i]), 1.0) for i in range(n)]
    return spark.createDataFrame(data, "cell_id string, label int, a double, b double, c double, d double").coalesce(1)


def fitted(spark, data, estimator):
    """By Spark ML and by this package, and the rows both have seen."""
    d = ml._assembler(COLS).transform(data.withColumn("label", F.col("label").cast("double"))).cache()
    got = d.select("label", vector_to_array("features").alias("x")).toPandas()
    p = {k.name: v for k, v in estimator.extractParamMap().items()}
    own = forest.fit_all(spark, np.array(got["x"].tolist()), got["label"].to_numpy(), estimator, {}, p)
    return estimator.fit(d), own, d


def shape(model):
    return [line.split(":")[0].split(" (weight")[0].strip() for t in model.trees for line in t.toDebugString.split("\n")[1:]]


def jobs(spark, name, work):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("depth", [0, 3, 30])
def test_a_tree_of_all_rows_and_features_is_spark_mls(spark, depth):
    theirs, own, d = fitted(spark, rows(spark), RandomForestClassifier(labelCol="label", numTrees=1, maxDepth=depth, minInstancesPerNode=2, bootstrap=False,
                                                                       featureSubsetStrategy="all", seed=1))
    assert shape(theirs) == shape(own) and theirs.totalNumNodes == own.totalNumNodes
    prob = [[r[0] for r in m.transform(d).select(vector_to_array("probability")[1]).collect()] for m in (theirs, own)]
    assert np.allclose(*prob, atol=1e-12)
    assert np.allclose(theirs.featureImportances.toArray(), own.featureImportances.toArray(), atol=1e-9)


def test_forests_agree_with_spark_mls_but_for_the_draws(spark):
    theirs, own, d = fitted(spark, rows(spark), RandomForestClassifier(labelCol="label", numTrees=150, maxDepth=6, featureSubsetStrategy="sqrt", seed=5))
    a, b = (np.array([r[0] for r in m.transform(d).select(vector_to_array("probability")[1]).collect()]) for m in (theirs, own))
    assert np.abs(a - b).mean() < 0.03 and np.corrcoef(a, b)[0, 1] > 0.98
    assert abs(theirs.totalNumNodes / own.totalNumNodes - 1) < 0.06
    assert np.abs(theirs.featureImportances.toArray() - own.featureImportances.toArray()).max() < 0.06


def test_cuts_are_spark_mls(spark):
    assert forest.cut_points(np.array([1.0, 1.0, 3.0, 0.0]), 32).tolist() == [0.5, 2.0] and len(forest.cut_points(np.ones(5), 32)) == 0
    x = np.random.default_rng(1).integers(-40, 40, 900).astype(float) ** 2
    values, counts = np.unique(x, return_counts=True)
    seen, target, cuts = counts[0], len(x) / 32, []
    for i in range(1, len(values)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            cuts.append((values[i - 1] + values[i]) / 2)
            target += len(x) / 32
    assert forest.cut_points(x, 32).tolist() == cuts
    assert [forest.subset_size(s, 13, 9) for s in ("sqrt", "log2", "all", "onethird", "auto", "2", "0.5")] == [4, 4, 13, 5, 4, 2, 7]


def test_forest_search_takes_a_task_for_each_fit(spark):
    data = rows(spark, 200)
    space = {"n_estimators": [10, 20], "max_depth": [4, None], "min_samples_leaf": [1, 3], "max_features": ["sqrt"]}
    (found, combos, _), n = jobs(spark, "forest-search", lambda: ml.train_random_forest(data, COLS, space=space, n_iter=6, folds=3))
    assert n < 40  # a job for each level of each of the 19 fits before
    best = int(np.argmax(found.avgMetrics))
    model = found.bestModel.stages[-1]
    assert len(found.avgMetrics) == len(found.stdMetrics) == len(combos) == 6
    assert model.getNumTrees == combos[best]["n_estimators"] and model.getMaxDepth() == (combos[best]["max_depth"] or 30)
    assert model.getMinInstancesPerNode() == combos[best]["min_samples_leaf"]
    again, _, _ = ml.train_random_forest(data.repartition(7), COLS, space=space, n_iter=6, folds=3)
    assert again.avgMetrics == found.avgMetrics and again.bestModel.stages[-1].toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("least", [1, 5])
def test_boosting_is_spark_mls(spark, least):
    theirs, own, d = fitted(spark, rows(spark), GBTClassifier(labelCol="label", maxIter=8, maxDepth=4, stepSize=0.2, minInstancesPerNode=least, seed=1))
    raw = [np.array([r[0] for r in m.transform(d).select(vector_to_array("rawPrediction")[1]).collect()]) for m in (theirs, own)]
    assert np.abs(raw[0] - raw[1]).max() < 1e-9 and theirs.treeWeights == own.treeWeights
    assert theirs.totalNumNodes == own.totalNumNodes and own.getMaxIter() == 8 and own.numFeatures == 4
    assert np.abs(theirs.featureImportances.toArray() - own.featureImportances.toArray()).max() < 1e-6


def test_boosting_search_takes_a_task_for_each_fit(spark):
    data = rows(spark, 200)
    space = {"n_estimators": [5, 10], "learning_rate": [0.1, 0.3], "max_depth": [3], "subsample": [0.8, 1.0], "min_samples_leaf": [1, 2]}
    (found, combos, _), n = jobs(spark, "boosting-search", lambda: ml.train_gradient_boosting(data, COLS, space=space, n_iter=5, folds=3))
    assert n < 40  # a job for each level of each tree of the 16 fits before
    best = int(np.argmax(found.avgMetrics))
    model = found.bestModel.stages[-1]
    assert len(found.avgMetrics) == len(combos) == 5 and model.getNumTrees == combos[best]["n_estimators"]
    assert model.treeWeights == [1.0] + [combos[best]["learning_rate"]] * (model.getNumTrees - 1)
    again, _, _ = ml.train_gradient_boosting(data.repartition(7), COLS, space=space, n_iter=5, folds=3)
    assert again.avgMetrics == found.avgMetrics and again.bestModel.stages[-1].toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


def test_more_rows_and_other_labels_are_left_to_spark_ml(spark, monkeypatch):
    data = rows(spark, 120)
    space = {"n_estimators": [4], "learning_rate": [0.2], "max_depth": [2], "subsample": [1.0], "min_samples_leaf": [1]}
    own = ml.train_gradient_boosting(data, COLS, space=space, n_iter=1, folds=2)[0]
    monkeypatch.setattr(ml, "TASK_FIT_ROWS", 119)
    monkeypatch.setattr(forest, "cross_validate", None)
    theirs = ml.train_gradient_boosting(data, COLS, space=space, n_iter=1, folds=2)[0]
    assert np.allclose(own.avgMetrics, theirs.avgMetrics) and np.allclose(own.stdMetrics, theirs.stdMetrics)
    monkeypatch.setattr(ml, "TASK_FIT_ROWS", 120)
    three = data.withColumn("label", F.when(F.col("a") > 5, 2).otherwise(F.col("label")))
    found = ml.train_random_forest(three, COLS, space={"n_estimators": [3], "max_depth": [3], "min_samples_leaf": [1], "max_features": ["all"]}, n_iter=1, folds=2)[0]
    assert found.bestModel.stages[-1].numClasses == 3
    with pytest.raises(Exception, match="(?i)null"):
        ml.train_random_forest(data.withColumn("a", F.when(F.col("b") > 9, F.col("a"))), COLS, n_iter=1, folds=2)


@pytest.fixture(scope="module")
def searched(spark):
    """The configured searches of both families on few rows: what the scoring queries begin with."""
    d = rows(spark, 240)
    d = d.select("cell_id", "label", *[F.col(COLS[i % 4]).alias(c) if i % 2 else (F.col(COLS[i % 4]) * (i + 1)).alias(c) for i, c in enumerate(q_ml.FEATURES_13)]).cache()
    parts = [d.where(F.pmod(F.xxhash64("cell_id"), F.lit(4)).isin(*k)) for k in ((0, 1), (2,), (3,))]
    found, n = jobs(spark, "both-searches", lambda: ml.train_all(parts[0], parts[1], q_ml.FEATURES_13, models=["random_forest", "gradient_boosting"]))
    return d, parts, found, n


@pytest.fixture
def few_rows(searched, monkeypatch):
    d, parts, found, _ = searched
    monkeypatch.setattr(q_ml, "_train_val_test", lambda c: parts)
    monkeypatch.setattr(q_ml, "model_table", lambda c: d)
    monkeypatch.setattr(ml, "train_all", lambda *a, **b: found)
    return d, parts, ml.select_best(found[0]).first()["model"]


def test_best_model_of_the_configured_searches(searched, few_rows):
    _, _, (results, fitted), n = searched
    assert n < 80  # far over ten thousand before
    for r in results.collect():
        model = fitted[r["model"]]
        assert model.stages[-1].getNumTrees == json.loads(r["params"])["n_estimators"]
        assert r["val_f1"] == ml.f1_evaluator().evaluate(ml.score(model, few_rows[1][1]))
    best = q_ml.q_best_model(None).first()
    assert best["model"] == few_rows[2] and best["val_f1"] == max(r["val_f1"] for r in results.collect())


def test_folds_are_ranked_once_for_a_search(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ml.CrossValidator, "fit", lambda self, data: seen.append(data))
    ml.train_logistic_regression(rows(spark, 60), COLS, folds=3)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Relation" in plan and seen[0].groupBy("fold").count().count() == 3


def test_batch_score_of_the_search(few_rows):
    scored = q_ml.q_batch_score(None).collect()
    assert len(scored) == few_rows[0].count() and all(abs(r["p_underserved"] + r["p_well_served"] - 1) < 1e-12 for r in scored)
    assert all((r["prediction"] == 1) == (r["p_well_served"] > 0.5) for r in scored)


def test_feature_importance_of_the_search(few_rows):
    found = q_ml.q_feature_importance(None).collect()
    assert {r["feature"] for r in found} == set(q_ml.FEATURES_13) and abs(sum(r["importance"] for r in found) - 1) < 1e-9
    assert found[0]["importance_rel"] == 1.0


def test_model_parity_of_the_search(spark, few_rows):
    found = q_ml.q_model_parity(types.SimpleNamespace(spark=spark)).first()
    assert found["n"] == few_rows[1][2].count() and found["class_diffs"] == 0 and found["ok"]


def test_test_metrics_of_the_search(few_rows):
    found = q_ml.q_test_metrics(None).first()
    assert found["model"] == few_rows[2] and found["f1"] > 0.7 and found["f1_ok"]
