"""Metric queries over a fixed scored table, and model training queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MODEL_FEATURES
from ..functions.seeded import sql_lit as L
from ..operators import metrics as mt
from ..operators import ml
from ..operators import split as sp
from ..session import ensure_checkpoint_dir, materialize
from .context import Ctx
from .q_labels import VIEWS
from .q_prep import SPLIT_CTES
from .queries import V, query

# The deterministic scorer used to test the metric operators
# (weights of trips, stops, population and the bias), rounded to 4 places.
SCORER = {"daily_trips_norm": 1.2, "stop_count_norm": 0.8, "population_norm": -0.6, "bias": 1.0}


def _scored(c: Ctx) -> DataFrame:
    x = (F.lit(SCORER["daily_trips_norm"]) * F.col("daily_trips_norm")
         + F.lit(SCORER["stop_count_norm"]) * F.col("stop_count_norm")
         + F.lit(SCORER["population_norm"]) * F.col("population_norm") + F.lit(SCORER["bias"]))
    s = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-x)), 4)
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    return d.select("cell_id", "label", s.alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int"))


_X = (f"{L(SCORER['daily_trips_norm'])} * daily_trips_norm + {L(SCORER['stop_count_norm'])} * stop_count_norm + "
      f"{L(SCORER['population_norm'])} * population_norm + {L(SCORER['bias'])}")
SCORED_CTES = [c for c in SPLIT_CTES if not c.startswith(("s1", "s2", "rest", "splits", "ds"))] + [
    (f"scored0 AS (SELECT f.cell_id, l.label, round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-({_X}))), 4) "
     f"AS score FROM fn f JOIN lbl l ON l.cell_id = f.cell_id)"),
    "scored AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored0)",
    ("cm AS (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 "
     "AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER "
     "(WHERE label = 1 AND prediction = 1) AS tp FROM scored)"),
]


def _d(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({a} AS DOUBLE) / ({b}) END)"


@query("confusion", V(
    "SELECT l.label, p.prediction, count(s.cell_id) AS count FROM (VALUES (0), (1)) l(label) CROSS JOIN "
    "(VALUES (0), (1)) p(prediction) LEFT JOIN scored s ON s.label = l.label AND s.prediction = p.prediction "
    "GROUP BY l.label, p.prediction", *VIEWS, ctes=SCORED_CTES))
def q_confusion(c: Ctx) -> DataFrame:
    """Confusion matrix of the fixed scorer."""
    return mt.confusion(_scored(c))


_P1, _R1 = _d("tp", "tp + fp"), _d("tp", "tp + fn")
_P0, _R0 = _d("tn", "tn + fn"), _d("tn", "tn + fp")
_F1, _F0 = _d(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}"), _d(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")


@query("class_report", V(
    f"SELECT '0' AS class, round({_P0}, 6) AS precision, round({_R0}, 6) AS recall, round({_F0}, 6) AS f1, "
    f"tn + fp AS support FROM cm UNION ALL "
    f"SELECT '1', round({_P1}, 6), round({_R1}, 6), round({_F1}, 6), tp + fn FROM cm UNION ALL "
    f"SELECT 'accuracy', NULL, NULL, round({_d('tp + tn', 'tn + fp + fn + tp')}, 6), tn + fp + fn + tp FROM cm "
    f"UNION ALL SELECT 'macro avg', round(({_P0} + {_P1}) / 2, 6), round(({_R0} + {_R1}) / 2, 6), "
    f"round(({_F0} + {_F1}) / 2, 6), tn + fp + fn + tp FROM cm UNION ALL "
    f"SELECT 'weighted avg', round({_d(f'{_P0} * (tn + fp) + {_P1} * (tp + fn)', 'tn + fp + fn + tp')}, 6), "
    f"round({_d(f'{_R0} * (tn + fp) + {_R1} * (tp + fn)', 'tn + fp + fn + tp')}, 6), "
    f"round({_d(f'{_F0} * (tn + fp) + {_F1} * (tp + fn)', 'tn + fp + fn + tp')}, 6), tn + fp + fn + tp FROM cm",
    *VIEWS, ctes=SCORED_CTES))
def q_class_report(c: Ctx) -> DataFrame:
    """Classification report of the fixed scorer."""
    r = mt.class_report(_scored(c))
    return r.withColumns({k: F.round(k, 6) for k in ("precision", "recall", "f1")})


_AUC = ("(SELECT (sum(CASE WHEN label = 1 THEN rk ELSE 0 END) - P * (P + 1) / 2.0) / (P * (n - P)) FROM "
        "(SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk, "
        "sum(label) OVER () AS P, count(*) OVER () AS n FROM scored) r GROUP BY P, n)")


@query("metrics", V(
    f"SELECT round({_d('tp + tn', 'tn + fp + fn + tp')}, 6) AS accuracy, round({_P1}, 6) AS precision, "
    f"round({_R1}, 6) AS recall, round({_F1}, 6) AS f1, round({_AUC}, 6) AS roc_auc FROM cm", *VIEWS,
    ctes=SCORED_CTES))
def q_metrics(c: Ctx) -> DataFrame:
    """V8: accuracy, precision, recall, F1 (class 1) and ROC AUC."""
    m = mt.metrics(_scored(c))
    return m.withColumns({k: F.round(k, 6) for k in m.columns})


@query("roc_points", V(
    "SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr UNION ALL "
    "SELECT score, round((sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) / CAST(sum(neg) OVER () AS "
    "DOUBLE), 6), round((sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) / CAST(sum(pos) OVER () AS "
    "DOUBLE), 6) FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score) g",
    *VIEWS, ctes=SCORED_CTES))
def q_roc_points(c: Ctx) -> DataFrame:
    """W2 + V9: ROC curve points, one per distinct score."""
    r = mt.roc_points(_scored(c))
    return r.withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


@query("baseline_majority", V(
    "SELECT round(avg(CASE WHEN label = m THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored, "
    "(SELECT label AS m FROM scored GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) mm", *VIEWS,
    ctes=SCORED_CTES))
def q_baseline_majority(c: Ctx) -> DataFrame:
    """Accuracy of always predicting the majority class."""
    d = _scored(c)
    maj = d.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(1)
    return (d.crossJoin(F.broadcast(maj.select(F.col("label").alias("m"))))
            .agg(F.round(F.avg((F.col("label") == F.col("m")).cast("double")), 6).alias("accuracy")))


@query("single_feature_rule", V(
    "SELECT round(avg(CASE WHEN l.label = (CASE WHEN f.daily_trips_norm >= 0 THEN 1 ELSE 0 END) THEN 1.0 ELSE 0.0 END), 6) "
    "AS accuracy, count(*) AS n FROM fn f JOIN lbl l ON l.cell_id = f.cell_id", *VIEWS, ctes=SCORED_CTES))
def q_single_feature_rule(c: Ctx) -> DataFrame:
    """Accuracy of calling a cell well served when its daily trips are at least the mean."""
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    hit = F.col("label") == F.when(F.col("daily_trips_norm") >= 0, 1).otherwise(0)
    return d.agg(F.round(F.avg(hit.cast("double")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


STUMP_FEATURES = ["stop_count", "route_count", "daily_trips", "population"]


def _stump_sql(c: str) -> str:
    """Every distinct value as threshold, in both directions."""
    return (f"SELECT * FROM (SELECT '{c}' AS feature, direction, threshold, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (SELECT d.direction, t.v AS threshold, "
            f"CASE WHEN d.direction = '>=' THEN (x.v >= t.v) = (x.label = 1) ELSE (x.v < t.v) = (x.label = 1) END AS hit "
            f"FROM (SELECT DISTINCT CAST({c} AS DOUBLE) AS v FROM fn) t CROSS JOIN (VALUES ('>='), ('<')) d(direction) CROSS JOIN (SELECT CAST(f.{c} AS DOUBLE) AS v, l.label FROM fn f JOIN lbl l ON l.cell_id = f.cell_id) x) h "
            f"GROUP BY direction, threshold ORDER BY avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) DESC, direction DESC, threshold LIMIT 1) b")


@query("best_single_rules", V(
    " UNION ALL ".join(map(_stump_sql, STUMP_FEATURES))
    + " UNION ALL SELECT 'majority', NULL, NULL, round(greatest(avg(label), 1 - avg(label)), 6) FROM lbl"
    + " UNION ALL SELECT 'model', NULL, NULL, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) FROM scored", *VIEWS,
    ctes=[c.replace("lbl AS (", "lbl AS MATERIALIZED (").replace("fn AS (", "fn AS MATERIALIZED (") for c in SCORED_CTES]))
def q_best_single_rules(c: Ctx) -> DataFrame:
    """The best threshold rule of each feature beside the majority class and the fixed scorer."""
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    rules = mt.best_threshold(d, STUMP_FEATURES)
    share = F.avg("label")
    none = [F.lit(None).cast("string").alias("direction"), F.lit(None).cast("double").alias("threshold")]
    majority = d.agg(F.greatest(share, 1 - share).alias("accuracy")).select(F.lit("majority").alias("feature"), *none, "accuracy")
    model = _scored(c).agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")).select(F.lit("model").alias("feature"), *none, "accuracy")
    return rules.unionByName(majority).unionByName(model).withColumn("accuracy", F.round("accuracy", 6))


#: The transit-only scorer leaves the population out of SCORER.
FEATURE_SETS = {"transit": ["daily_trips_norm", "stop_count_norm"], "enriched": ["daily_trips_norm", "stop_count_norm", "population_norm"]}


def _set_x(names: list[str]) -> str:
    return " + ".join([*(f"{L(SCORER[n])} * {n}" for n in names), L(SCORER["bias"])])


def _set_sql(name: str, other: str) -> str:
    s = f"s_{name}"
    auc = (f"(SELECT (sum(CASE WHEN label = 1 THEN rk ELSE 0 END) - P * (P + 1) / 2.0) / (P * (n - P)) FROM (SELECT label, rank() OVER (ORDER BY {s}) + "
           f"(count(*) OVER (PARTITION BY {s}) - 1) / 2.0 AS rk, sum(label) OVER () AS P, count(*) OVER () AS n FROM sets) r GROUP BY P, n)")
    return (f"SELECT '{name}' AS feature_set, {len(FEATURE_SETS[name])} AS n_features, n AS rows, round({_d('tp + tn', 'n')}, 6) AS accuracy, round({_P1}, 6) AS precision, round({_R1}, 6) AS recall, "
            f"round({_F1}, 6) AS f1, round({auc}, 6) AS roc_auc, b AS only_this, round(CASE WHEN b + c = 0 THEN 0 ELSE (abs(b - c) - 1) * (abs(b - c) - 1) / CAST(b + c AS DOUBLE) END, 6) AS chi2 FROM ("
            f"SELECT count(*) AS n, count(*) FILTER (WHERE label = 0 AND p_{name} = 0) AS tn, count(*) FILTER (WHERE label = 0 AND p_{name} = 1) AS fp, count(*) FILTER (WHERE label = 1 AND p_{name} = 0) AS fn, "
            f"count(*) FILTER (WHERE label = 1 AND p_{name} = 1) AS tp, count(*) FILTER (WHERE p_{name} = label AND p_{other} <> label) AS b, "
            f"count(*) FILTER (WHERE p_{name} <> label AND p_{other} = label) AS c FROM sets) k")


@query("feature_set_comparison", V(
    f"{_set_sql('transit', 'enriched')} UNION ALL {_set_sql('enriched', 'transit')}", *VIEWS, ctes=SPLIT_CTES + [
        "sets AS MATERIALIZED (SELECT *, CASE WHEN s_transit >= 0.5 THEN 1 ELSE 0 END AS p_transit, CASE WHEN s_enriched >= 0.5 THEN 1 ELSE 0 END AS p_enriched FROM (SELECT f.cell_id, s.label, "
        + ", ".join(f"round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-({_set_x(v)}))), 4) AS s_{k}" for k, v in FEATURE_SETS.items())
        + " FROM fn f JOIN splits s ON s.cell_id = f.cell_id WHERE s.split = 'test') x)"]))
def q_feature_set_comparison(c: Ctx) -> DataFrame:
    """Transit-only and enriched scorers on the test rows, with the paired test (fixed coefficients)."""
    def score(names):
        x = sum((F.lit(SCORER[n]) * F.col(n) for n in names[1:]), F.lit(SCORER[names[0]]) * F.col(names[0])) + F.lit(SCORER["bias"])
        return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-x)), 4)

    test = sp.stratified_split(c.labels.select("cell_id", "label")).where("split = 'test'")
    d = c.features_pop.join(test, "cell_id").select("cell_id", "label", *[score(v).alias(f"s_{k}") for k, v in FEATURE_SETS.items()])
    found = mt.compare_feature_sets(materialize(d, "feature-sets"), {k: (f"s_{k}", v) for k, v in FEATURE_SETS.items()})
    return found.withColumns({k: F.round(k, 6) for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "chi2")})


@query("analysis_table", V(
    "SELECT f.cell_id, f.population, l.label FROM fn f LEFT JOIN lbl l ON l.cell_id = f.cell_id AND l.label = 1",
    *VIEWS, ctes=SCORED_CTES))
def q_analysis_table(c: Ctx) -> DataFrame:
    """Every cell of the feature table, with the label where the cell is labelled well served."""
    labelled = c.labels.where("label = 1").select("cell_id", "label")
    return c.features_pop.select("cell_id", "population").join(labelled, "cell_id", "left")


@query("priority_cells", V(
    "SELECT f.cell_id, f.population FROM fn f JOIN lbl l ON l.cell_id = f.cell_id WHERE l.label = 0 "
    "ORDER BY f.population DESC, f.cell_id LIMIT 20", *VIEWS, ctes=SCORED_CTES))
def q_priority_cells(c: Ctx) -> DataFrame:
    """X6 + T1: the 20 most populous underserved cells."""
    d = c.features_pop.select("cell_id", "population").join(c.labels.where("label = 0").select("cell_id"), "cell_id", "left_semi")
    return d.orderBy(F.desc("population"), "cell_id").limit(20)


@query("scored_classes", V(
    "SELECT cell_id, prediction, CASE WHEN prediction = 1 THEN 'well_served' ELSE 'underserved' END AS predicted_class, "
    "round(1 - score, 4) AS p_underserved, score AS p_well_served, round(greatest(score, 1 - score), 4) AS confidence "
    "FROM scored", *VIEWS, ctes=SCORED_CTES))
def q_scored_classes(c: Ctx) -> DataFrame:
    """V6 + P13 + C21: the columns of batch scoring, for every cell, from the fixed scorer."""
    s = F.col("score")
    out = ml.name_scores(_scored(c), F.col("prediction"), F.round(1 - s, 4), s)
    return out.withColumn("confidence", F.round("confidence", 4))


# ----------------------------------------------------------------- models ---

def model_table(c: Ctx) -> DataFrame:
    """Cell geometry columns + features + population (the model's inputs)."""
    geo = c.cells.select("cell_id", "lat_min", "lat_max", "lon_min", "lon_max", "centroid_lat", "centroid_lon",
                         "area_km2")
    return geo.join(c.features_pop, "cell_id")


def _train_val_test(c: Ctx):
    ds = sp.merge_features_labels(model_table(c), c.labels)
    s = materialize(sp.stratified_split(ds), "splits")
    return s.filter("split = 'train'"), s.filter("split = 'val'"), s.filter("split = 'test'")


FEATURES_13 = MODEL_FEATURES


@query("train_lr")
def q_train_lr(c: Ctx) -> DataFrame:
    """V1 + V4: logistic regression grid search (4 values of C, 5 stratified folds)."""
    tr, va, _ = _train_val_test(c)
    res, _ = ml.train_all(tr, va, FEATURES_13, models=["logistic_regression"])
    return res.select("model", "params", "cv_f1", "val_f1")


@query("train_rf")
def q_train_rf(c: Ctx) -> DataFrame:
    """V2: random forest randomized search (20 draws of the configured space, 5 folds)."""
    tr, va, _ = _train_val_test(c)
    res, _ = ml.train_all(tr, va, FEATURES_13, models=["random_forest"])
    return res.select("model", "params", "cv_f1", "val_f1")


@query("train_gbt")
def q_train_gbt(c: Ctx) -> DataFrame:
    """V3: gradient boosting randomized search (15 draws of the configured space, 5 folds)."""
    tr, va, _ = _train_val_test(c)
    res, _ = ml.train_all(tr, va, FEATURES_13, models=["gradient_boosting"])
    return res.select("model", "params", "cv_f1", "val_f1")


def _fit_best(c: Ctx):
    """Name and fitted model of the best of the three families, feature names, test split."""
    tr, va, te = _train_val_test(c)
    res, fitted = ml.train_all(tr, va, FEATURES_13)
    best = ml.select_best(res).first()["model"]
    return best, fitted[best], FEATURES_13, te


@query("best_model")
def q_best_model(c: Ctx) -> DataFrame:
    """V5: best family by validation F1 (all three families, the configured searches)."""
    tr, va, _ = _train_val_test(c)
    res, _ = ml.train_all(tr, va, FEATURES_13)
    return ml.select_best(res).select("model", "val_f1")


@query("test_metrics")
def q_test_metrics(c: Ctx) -> DataFrame:
    """V8 + V12 + V14: test metrics, F1 gate and status of the best model."""
    name, model, _, te = _fit_best(c)
    return ml.evaluate(model, te.withColumn("label", F.col("label").cast("double")), name)


@query("feature_importance")
def q_feature_importance(c: Ctx) -> DataFrame:
    """Relative importance of the best model."""
    _, model, cols, _ = _fit_best(c)
    return ml.feature_importance(model, cols)


@query("batch_score")
def q_batch_score(c: Ctx) -> DataFrame:
    """V6 + V7: score every cell with the best model."""
    _, model, cols, _ = _fit_best(c)
    return ml.batch_score(model, model_table(c), cols)


@query("model_parity")
def q_model_parity(c: Ctx) -> DataFrame:
    """V13 + S14: saved and reloaded model agree on the whole test split."""
    _, model, _, te = _fit_best(c)
    path = os.path.join(ensure_checkpoint_dir(c.spark), f"model-{uuid.uuid4().hex[:8]}")
    return ml.parity_check(model, path, te.withColumn("label", F.col("label").cast("double")))
