"""Model search, selection, scoring and checks with Spark ML (V1-V7, V10-V14,
S14, S15).

Estimators are Spark ML, folds are a stratified seeded column (``foldCol``), and search
results are DataFrames. Training rows stay distributed, but for the searches of tree
ensembles on a table that a count shows to have at most TASK_FIT_ROWS rows: there each
fit is a task of its own (``forest``). Other driver-side values are the parameter grids,
per-model timings and model coefficients (bounded by the number of features).
"""

from __future__ import annotations

import itertools
import json
import logging
import random
import time

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CV_FOLDS, GBT_N_ITER, GBT_SPACE, LR_GRID, MIN_F1, RF_N_ITER, RF_SPACE, SEED
from ..functions.seeded import seeded_uniform
from ..session import materialize
from . import forest
from .metrics import f1_status, metrics
from .prep import NUMERIC, feature_columns, relabel
from .ranking import hash_rank

log = logging.getLogger(__name__)

MAX_TREE_DEPTH = 30  # deepest tree Spark ML accepts; "no limit" maps here
#: Spark ML trees have no such parameter: it is not drawn, so that every draw is another model.
NOT_IN_SPARK = {"min_samples_split"}
#: Most training rows that go to every task of a search of tree ensembles (the configured grid has about 14,100);
#: with more, Spark ML grows each fit over distributed rows.
TASK_FIT_ROWS = 100_000


def f1_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def with_folds(df: DataFrame, k: int = CV_FOLDS, seed: int = SEED, key: str = "cell_id") -> DataFrame:
    """Stratified fold ids: rank inside each class by seeded key, mod k."""
    ranked = hash_rank(df.withColumn("_fk", seeded_uniform(f"fold-{seed}", key)), "_fk", group=["label"],
                       tiebreak=[key], out="_fr")
    return ranked.withColumn("fold", (F.col("_fr") % k).cast("int")).drop("_fk", "_fr")


def sample_space(space: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """Randomized search: ``n_iter`` distinct combinations drawn with a seeded RNG."""
    keys = [k for k in space if k not in NOT_IN_SPARK]
    combos = list(itertools.product(*[space[k] for k in keys]))
    rng = random.Random(seed)
    picked = rng.sample(combos, min(n_iter, len(combos)))
    return [dict(zip(keys, c)) for c in picked]


def _assembler(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")


def _search(train: DataFrame, cols: list[str], estimator, grid: list, folds: int, parallelism: int):
    data = with_folds(train.select("cell_id", "label", *cols), folds)
    data = data.withColumn("label", F.col("label").cast("double"))
    if isinstance(estimator, (RandomForestClassifier, GBTClassifier)) and train.limit(TASK_FIT_ROWS + 1).count() <= TASK_FIT_ROWS:
        found = _search_in_tasks(data, cols, estimator, grid, folds)
        if found is not None:
            return found
    data = materialize(data, "folds")  # the search reads it for each fold, twice
    pipe = Pipeline(stages=[_assembler(cols), estimator])
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=f1_evaluator(), foldCol="fold", numFolds=folds,
                        parallelism=parallelism, seed=SEED)
    return cv.fit(data)


def _search_in_tasks(data: DataFrame, cols: list[str], estimator, grid: list, folds: int) -> CrossValidatorModel | None:
    """The search with a task for each fit; None where a label is not 0 or 1 or a fold lacks rows or ones: Spark ML has its rules for these."""
    rows = _assembler(cols).transform(data).orderBy("cell_id", "label", *cols).select("label", "fold", vector_to_array("features").alias("x")).toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(cols))
    y, fold = (rows[c].to_numpy() for c in ("label", "fold"))
    if not np.isin(y, (0, 1)).all() or any(not (y[fold == k] == 1).any() or (fold == k).all() for k in range(folds)):
        return None
    settings = [{k.name: v for k, v in estimator.extractParamMap(params).items()} for params in grid]
    f1 = forest.cross_validate(data.sparkSession, x, y, fold, estimator, settings, folds)
    best = int(np.argmax(f1.mean(axis=0)))
    model = forest.fit_all(data.sparkSession, x, y, estimator, grid[best], settings[best])
    return CrossValidatorModel(PipelineModel([_assembler(cols), model]), list(f1.mean(axis=0)), None, list(f1.std(axis=0)))


def train_logistic_regression(train: DataFrame, cols: list[str] | None = None, grid: dict = LR_GRID,
                               folds: int = CV_FOLDS, parallelism: int = 4):
    """V1: L2 logistic regression, exhaustive grid over C; Spark's regParam is
    1 / (C * n_train) so the penalty weight matches the C-scaled objective.

    The raw inputs (coordinates near -20/-44, population in thousands) are
    badly conditioned, so the optimizer works on standardized features
    (Spark returns coefficients on the original scale); the penalty therefore
    applies to standardized coefficients."""
    cols = cols or feature_columns(train)
    n = train.count()
    lr = LogisticRegression(labelCol="label", featuresCol="features", elasticNetParam=0.0, standardization=True,
                            tol=1e-4)
    combos = [{"C": c, "max_iter": m} for c in grid["C"] for m in grid["max_iter"]]
    pgrid = [{lr.regParam: 1.0 / (p["C"] * n), lr.maxIter: p["max_iter"]} for p in combos]
    return _search(train, cols, lr, pgrid, folds, parallelism), combos, cols


def train_random_forest(train: DataFrame, cols: list[str] | None = None, space: dict = RF_SPACE,
                        n_iter: int = RF_N_ITER, folds: int = CV_FOLDS, parallelism: int = 4):
    """V2: random forest, randomized search. ``parallelism`` is for tables beyond TASK_FIT_ROWS."""
    cols = cols or feature_columns(train)
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", seed=SEED, bootstrap=True)
    combos = sample_space(space, n_iter)
    if any(not p["max_depth"] or p["max_depth"] > MAX_TREE_DEPTH for p in combos):
        log.warning("random forest: trees without a depth limit are grown to depth %s", MAX_TREE_DEPTH)
    pgrid = [{rf.numTrees: p["n_estimators"], rf.maxDepth: min(p["max_depth"] or MAX_TREE_DEPTH, MAX_TREE_DEPTH),
              rf.minInstancesPerNode: p["min_samples_leaf"], rf.featureSubsetStrategy: p["max_features"]}
             for p in combos]
    return _search(train, cols, rf, pgrid, folds, parallelism), combos, cols


def train_gradient_boosting(train: DataFrame, cols: list[str] | None = None, space: dict = GBT_SPACE,
                            n_iter: int = GBT_N_ITER, folds: int = CV_FOLDS, parallelism: int = 4):
    """V3: gradient-boosted trees, randomized search. ``parallelism`` is for tables beyond TASK_FIT_ROWS."""
    cols = cols or feature_columns(train)
    gb = GBTClassifier(labelCol="label", featuresCol="features", seed=SEED)
    combos = sample_space(space, n_iter)
    pgrid = [{gb.maxIter: p["n_estimators"], gb.stepSize: p["learning_rate"], gb.maxDepth: p["max_depth"],
              gb.subsamplingRate: p["subsample"], gb.minInstancesPerNode: p["min_samples_leaf"]} for p in combos]
    return _search(train, cols, gb, pgrid, folds, parallelism), combos, cols


CLASS_NAMES = {0: "underserved", 1: "well_served"}

TRAINERS = {"logistic_regression": train_logistic_regression, "random_forest": train_random_forest,
            "gradient_boosting": train_gradient_boosting}


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Model output with class-1 probability as ``score``."""
    out = model.transform(df.withColumn("label", F.col("label").cast("double")) if "label" in df.columns else df)
    return out.withColumn("score", vector_to_array("probability")[1])


def train_all(train: DataFrame, val: DataFrame, cols: list[str] | None = None, models: list[str] | None = None,
              **kw) -> tuple[DataFrame, dict]:
    """V4: fit each family, time it, score the validation split.

    Returns a results frame (model, params, cv_f1, val_f1, train_seconds) and
    the fitted best pipeline of each family."""
    cols = cols or feature_columns(train)
    rows, fitted = [], {}
    for name in models or list(TRAINERS):
        opts = {k: v for k, v in kw.get(name, {}).items()}
        t0 = time.time()
        cvm, combos, _ = TRAINERS[name](train, cols, **opts)
        secs = time.time() - t0
        best_i = max(range(len(cvm.avgMetrics)), key=lambda i: cvm.avgMetrics[i])
        val_f1 = f1_evaluator().evaluate(score(cvm.bestModel, val))
        fitted[name] = cvm.bestModel
        rows.append((name, json.dumps(combos[best_i], default=str), float(cvm.avgMetrics[best_i]), float(val_f1),
                     float(secs)))
    spark = train.sparkSession
    res = spark.createDataFrame(rows, "model string, params string, cv_f1 double, val_f1 double, "
                                      "train_seconds double")
    return res, fitted


def select_best(results: DataFrame) -> DataFrame:
    """V5 / T4: the model with the highest validation F1; the first in the
    family order wins a tie."""
    order = F.when(F.col("model") == "logistic_regression", 0).when(F.col("model") == "random_forest", 1).otherwise(2)
    return results.withColumn("_o", order).orderBy(F.desc("val_f1"), "_o").limit(1).drop("_o")


def validate_features(df: DataFrame, expected: list[str]) -> DataFrame:
    """V7: missing -> error, extra -> ignored, non-numeric -> error,
    columns reordered to the model's order. Plan-time, no job."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")
    bad = [c for c in expected if not isinstance(df.schema[c].dataType, NUMERIC)]
    if bad:
        raise ValueError(f"Non-numeric features: {bad}")
    keep = [c for c in ("cell_id",) if c in df.columns]
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in expected])


def batch_score(model: PipelineModel, df: DataFrame, expected: list[str]) -> DataFrame:
    """V6: prediction, class name, both probabilities and confidence per row.
    A stateless transform: also valid on a streaming DataFrame."""
    x = validate_features(df, expected)
    p = vector_to_array("probability")
    return name_scores(model.transform(x), F.col("prediction"), p[0], p[1])


def name_scores(scored: DataFrame, prediction, p0, p1) -> DataFrame:
    """V6 output columns from the columns of any scorer: prediction, class
    name, both probabilities and the larger one as confidence."""
    return scored.select(
        *[c for c in ("cell_id",) if c in scored.columns],
        prediction.cast("int").alias("prediction"),
        relabel(prediction, CLASS_NAMES).alias("predicted_class"),
        p0.alias("p_underserved"), p1.alias("p_well_served"), F.greatest(p0, p1).alias("confidence"))


def feature_importance(model: PipelineModel, cols: list[str]) -> DataFrame:
    """Importances divided by their maximum; linear models use |coef|."""
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        raw = est.featureImportances.toArray().tolist()
    else:
        raw = [abs(v) for v in est.coefficients.toArray().tolist()]
    top = max(raw) if raw and max(raw) > 0 else 1.0
    rows = [(c, float(v), float(v) / top) for c, v in zip(cols, raw)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double, importance_rel double").orderBy(
        F.desc("importance"), "feature")


def compare_importance(a: DataFrame, b: DataFrame, name_a: str = "rf", name_b: str = "gb") -> DataFrame:
    """Raw importances of two models side by side, sorted by the first."""
    return (a.select("feature", F.col("importance").alias(name_a))
            .join(b.select("feature", F.col("importance").alias(name_b)), "feature", "full")
            .orderBy(F.desc(name_a), "feature"))


def evaluate(model: PipelineModel, test: DataFrame, name: str = "model") -> DataFrame:
    """V8 + V12 + V14 on the test split."""
    m = metrics(score(model, test))
    return m.select(F.lit(name).alias("model"), "*", (F.col("f1") >= MIN_F1).alias("f1_ok"),
                    f1_status(F.col("f1")).alias("status"))


def parity_check(model: PipelineModel, path: str, df: DataFrame, n_samples: int | None = None, tol: float = 1e-5) -> DataFrame:
    """V13 re-aimed: save, reload, score every row (or the first ``n_samples``
    by key) with both, and compare classes and probabilities."""
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    rows = df if n_samples is None else df.orderBy("cell_id").limit(n_samples)
    a = score(model, rows).select("cell_id", F.col("prediction").alias("p1"), F.col("score").alias("s1"))
    b = score(again, rows).select("cell_id", F.col("prediction").alias("p2"), F.col("score").alias("s2"))
    j = a.join(b, "cell_id")
    return j.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("p1") != F.col("p2")).cast("int")).alias("class_diffs"),
                 F.max(F.abs(F.col("s1") - F.col("s2"))).alias("max_prob_diff")).withColumn(
        "ok", (F.col("class_diffs") == 0) & (F.col("max_prob_diff") < tol))


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML writer."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_metadata(spark, path: str, name: str, cols: list[str], results: DataFrame | None = None) -> None:
    """One-row JSON with model name, feature names and training date."""
    meta = spark.createDataFrame([(name, cols, time.strftime("%Y-%m-%dT%H:%M:%S"))],
                                 T.StructType([T.StructField("model_name", T.StringType()),
                                               T.StructField("feature_names", T.ArrayType(T.StringType())),
                                               T.StructField("training_date", T.StringType())]))
    if results is not None:
        meta = meta.crossJoin(results.filter(F.col("model") == name).select("cv_f1", "val_f1"))
    meta.coalesce(1).write.mode("overwrite").json(path)

