"""Classification metrics from counts.

Confusion counts come from one ``groupBy(label, prediction)``; every other
metric is arithmetic on that 4-row table. ROC points and AUC use per-score
positive/negative counts with cumulative sums computed by ``cumulative_by_value``
(bucketed by approximate cut points, so no single-task global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import one_row, with_bucket


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Counts for all four (label, prediction) pairs in {0, 1}^2."""
    got = df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "label int, prediction int")
    return grid.join(got, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("count", F.lit(0)).alias("count"))


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    c = confusion(df, label, pred)
    g = lambda a, b: F.sum(F.when((F.col("label") == a) & (F.col("prediction") == b), F.col("count")).otherwise(0))  # noqa: E731,E501
    return c.agg(g(0, 0).alias("tn"), g(0, 1).alias("fp"), g(1, 0).alias("fn"), g(1, 1).alias("tp"))


def _div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Precision / recall / F1 / support per class, accuracy, macro and
    weighted averages (zero division -> 0)."""
    k = _counts(df, label, pred)
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1 = _div(2 * p1 * r1, p1 + r1)
    f0 = _div(2 * p0 * r0, p0 + r0)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    acc = _div(tp + tn, n)
    rows = [
        ("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n), _div(f0 * s0 + f1 * s1, n), n),
    ]
    parts = [k.select(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                      s.cast("long").alias("support")) for name, p, r, f, s in rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cumulative_by_value(df: DataFrame, col: str, sums: dict, buckets: int = 256,
                        accuracy: int = 10000) -> DataFrame:
    """Per distinct value of ``col``: the given sums and their totals over all
    smaller values (``<name>_less``). Buckets by approximate cut points."""
    vc = df.groupBy(col).agg(*[e.alias(n) for n, e in sums.items()])
    probs = [i / buckets for i in range(1, buckets)]
    cuts = vc.agg(F.percentile_approx(col, probs, accuracy).alias("_cuts"))
    data = with_bucket(vc.crossJoin(one_row(cuts)), col, "_cuts").drop("_cuts")
    per_bucket = data.groupBy("_bk").agg(*[F.sum(n).alias(f"_b_{n}") for n in sums])
    w = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # <= buckets rows
    offs = per_bucket.select("_bk", *[F.coalesce(F.sum(f"_b_{n}").over(w), F.lit(0)).alias(f"_o_{n}")
                                      for n in sums])
    data = data.join(one_row(offs), "_bk")
    wl = Window.partitionBy("_bk").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    return data.select(col, *sums.keys(), *[
        (F.col(f"_o_{n}") + F.coalesce(F.sum(n).over(wl), F.lit(0))).alias(f"{n}_less") for n in sums])


def roc_points(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One ROC point per distinct score threshold (predict 1 when
    score >= threshold), plus the origin."""
    pos = F.sum(F.col(label).cast("long"))
    neg = F.sum(1 - F.col(label).cast("long"))
    cum = cumulative_by_value(df, score, {"pos": pos, "neg": neg})
    tot = df.agg(pos.alias("_P"), neg.alias("_N"))
    pts = cum.crossJoin(one_row(tot)).select(
        F.col(score).alias("threshold"),
        _div(F.col("_N") - F.col("neg_less"), F.col("_N")).alias("fpr"),
        _div(F.col("_P") - F.col("pos_less"), F.col("_P")).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(pts.select(F.col("threshold").cast("double"), "fpr", "tpr"))


def auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC AUC by the rank-sum statistic with average ranks for ties:
    (sum of positive ranks - P(P+1)/2) / (P * N)."""
    pos = F.sum(F.col(label).cast("long"))
    cnt = F.count(F.lit(1))
    cum = cumulative_by_value(df, score, {"pos": pos, "cnt": cnt})
    # average rank of the tied block: cnt_less + (cnt + 1) / 2
    s = cum.agg(F.sum(F.col("pos") * (F.col("cnt_less") + (F.col("cnt") + 1) / 2)).alias("_rs"),
                F.sum("pos").alias("_P"), F.sum("cnt").alias("_n"))
    p, n = F.col("_P"), F.col("_n") - F.col("_P")
    return s.select(_div(F.col("_rs") - p * (p + 1) / 2, p * n).alias("roc_auc"))


def metrics(df: DataFrame, label: str = "label", pred: str = "prediction", score: str | None = "score") -> DataFrame:
    """V8: accuracy, precision, recall, F1 for class 1, and ROC AUC."""
    k = _counts(df, label, pred)
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    p, r = _div(tp, tp + fp), _div(tp, tp + fn)
    out = k.select(_div(tp + tn, tn + fp + fn + tp).alias("accuracy"), p.alias("precision"), r.alias("recall"),
                   _div(2 * p * r, p + r).alias("f1"))
    if score:
        out = out.crossJoin(one_row(auc(df, score, label)))
    return out


def f1_status(f1) -> F.Column:
    """Status band of an F1 score."""
    return (F.when(f1 >= 0.98, "suspicious").when(f1 >= 0.90, "excellent").when(f1 >= 0.80, "good")
            .when(f1 >= 0.70, "acceptable").otherwise("below target"))


def best_threshold(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """The best one-feature rule of each feature: feature, direction (predict 1 when value >= or < threshold),
    threshold, accuracy.

    Every distinct value is tried, from the class counts of all smaller values; ties go to ``>=`` and to the smaller
    threshold. Rows with a null feature or label are left out.
    """
    parts = []
    for c in features:
        pos, neg = F.sum(F.col(label).cast("long")), F.sum(1 - F.col(label).cast("long"))
        rows = df.where(F.col(c).isNotNull() & F.col(label).isNotNull()).select(F.col(c).cast("double").alias("_v"), label)
        tried = cumulative_by_value(rows, "_v", {"pos": pos, "neg": neg})
        total = rows.agg(pos.alias("_P"), F.count(F.lit(1)).alias("_n"))
        hits = F.col("neg_less") + F.col("_P") - F.col("pos_less")
        rules = F.inline(F.array(F.struct(F.lit(">=").alias("direction"), hits.alias("_hits")), F.struct(F.lit("<").alias("direction"), (F.col("_n") - hits).alias("_hits"))))
        rules = tried.crossJoin(one_row(total)).select("_v", "_n", rules)
        # the greatest of (hits, ">=" first, smallest threshold)
        best = rules.agg(F.max_by(F.struct("direction", "_v", "_hits", "_n"), F.struct("_hits", F.col("direction") == ">=", -F.col("_v"))).alias("b"))
        parts.append(best.select(F.lit(c).alias("feature"), "b.direction", F.col("b._v").alias("threshold"), _div(F.col("b._hits"), F.col("b._n")).alias("accuracy")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_feature_sets(df: DataFrame, sets: dict[str, tuple[str, list[str]]], label: str = "label", cut: float = 0.5) -> DataFrame:
    """Two scorers on the same rows, side by side: metrics, inputs, and McNemar's paired test on their errors.

    ``sets`` names two scorers: (score column, inputs). ``only_this`` counts the rows that this scorer alone calls
    right; ``chi2`` is (|b - c| - 1)^2 / (b + c) over the discordant rows, 0 without any.
    """
    (_, (a, _)), (_, (b, _)) = sets.items()
    right = {s: F.col(label) == (F.col(s) >= cut).cast("int") for s in (a, b)}
    paired = df.agg(*[F.count(F.when(right[s] & ~right[o], 1)).alias(f"_only_{k}") for k, (s, o) in enumerate(((a, b), (b, a)))], F.count(F.lit(1)).alias("rows"))
    gap = F.abs(F.col("_only_0") - F.col("_only_1")) - 1
    paired = paired.withColumn("chi2", _div(gap * gap, F.col("_only_0") + F.col("_only_1")))
    parts = []
    for k, (name, (score, inputs)) in enumerate(sets.items()):
        m = metrics(df.select(label, F.col(score).alias("score"), (F.col(score) >= cut).cast("int").alias("prediction")), label)
        parts.append(m.crossJoin(one_row(paired)).select(F.lit(name).alias("feature_set"), F.lit(len(inputs)).alias("n_features"), "rows", *m.columns, F.col(f"_only_{k}").alias("only_this"), "chi2"))
    return parts[0].unionByName(parts[1])
