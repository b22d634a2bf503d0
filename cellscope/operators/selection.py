"""Univariate feature scoring.

ANOVA F comes from per-class count, sum and sum of squares (one groupBy);
mutual information is estimated from nearest neighbours (``mutual_info``) or from equal-width
bins of each feature against the label (one groupBy, counts only). All return one row per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import ieee_div, one_row, positions

#: Neighbours of the mutual-information estimate, and rows of a class that are sorted together.
NEIGHBOURS, BLOCK_ROWS = 3, 50_000


def anova_f(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """F = (SSB / (k - 1)) / (SSW / (n - k)) per feature, largest first; over 0 (a feature that is constant in
    every class, a single class) an infinity or NaN, which comes first."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[e for c in features for e in (
        F.sum(F.col(c).cast("double")).alias(f"{c}__s"), F.sum(F.col(c).cast("double") ** 2).alias(f"{c}__q"))])
    tot = per.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"), *[e for c in features for e in (
        F.sum(f"{c}__s").alias(f"{c}__S"), F.sum(f"{c}__q").alias(f"{c}__Q"),
        F.sum(F.col(f"{c}__s") ** 2 / F.col("_n")).alias(f"{c}__B"))])
    rows = []
    for c in features:
        ssb = F.col(f"{c}__B") - F.col(f"{c}__S") ** 2 / F.col("n")
        ssw = F.col(f"{c}__Q") - F.col(f"{c}__B")
        f = ieee_div(ieee_div(ssb, F.col("k") - 1), ieee_div(ssw, F.col("n") - F.col("k")))
        rows.append(F.struct(F.lit(c).alias("feature"), f.alias("f_score")))
    return tot.select(F.inline(F.array(*rows))).orderBy(F.desc("f_score"), "feature")


def select_k_best(df: DataFrame, features: list[str], k: int = 10, label: str = "label",
                  method: str = "f_classif") -> DataFrame:
    """The k best features by ANOVA F (``f_classif``), nearest-neighbour or binned mutual information
    (``mutual_info``, ``mutual_info_binned``)."""
    scores = {"f_classif": anova_f, "mutual_info": mutual_info, "mutual_info_binned": mutual_info_binned}[method](df, features, label=label)
    col = "f_score" if method == "f_classif" else "mutual_info"
    return scores.orderBy(F.desc(col), "feature").limit(k)


def mutual_info_binned(df: DataFrame, features: list[str], label: str = "label", bins: int = 10) -> DataFrame:
    """M20 (mutual_info variant): MI in nats between equal-width bins of each
    feature and the label. An estimate on bins, not a k-nearest-neighbour one.

    One pass for the ranges and one for the counts; what follows has at most
    features x bins x classes rows. Rows with a null feature or label count
    in the total only.
    """
    ends = df.agg(*[e for c in features for e in (F.min(c).cast("double").alias(f"{c}__mn"),
                                                  F.max(c).cast("double").alias(f"{c}__mx"))])
    entries = []
    for c in features:
        lo = F.col(f"{c}__mn")
        width = (F.col(f"{c}__mx") - lo) / bins
        b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col(c) - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
        entries.append(F.struct(F.lit(c).alias("feature"), b.cast("int").alias("bin")))
    each = df.select(label, *features).crossJoin(one_row(ends)).select(F.col(label).alias("y"), F.inline(F.array(*entries)))
    joint = each.groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("c"))
    total = {n: F.sum("c").over(Window.partitionBy(*keys)) for n, keys in
             (("n", ["feature"]), ("cb", ["feature", "bin"]), ("cy", ["feature", "y"]))}
    known = joint.withColumns(total).where("bin is not null and y is not null")
    term = F.col("c") / F.col("n") * F.log(F.col("c") * F.col("n") / (F.col("cb") * F.col("cy")))
    return known.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def digamma(n) -> F.Column:
    """Digamma of whole numbers from 1: eight steps of the recurrence, then the asymptotic series."""
    x = n.cast("double")
    y = x + 8
    series = F.log(y) - 1 / (2 * y) - 1 / (12 * y ** 2) + 1 / (120 * y ** 4) - 1 / (252 * y ** 6)
    return series - sum((1 / (x + j) for j in range(1, 8)), 1 / x)


def _radii(ranked: DataFrame, k: int, block: int) -> DataFrame:
    """Distance to the k-th nearest value of the same class, over rows with _r (place inside feature and class) and _size.

    Rows are cut into blocks of consecutive places; a block also gets the k rows on either side of it, so a class of
    any size is worked on block by block.
    """
    home = F.floor(F.col("_r") / block)
    near = [F.floor((F.col("_r") + d) / block) for d in (-k, 0, k)]
    halo = ranked.withColumn("_block", F.explode(F.array_distinct(F.array(*near))))
    w = Window.partitionBy("_feature", "_label", "_block").orderBy("_r")
    gaps = [F.col("_x") - F.lag("_x", j).over(w) for j in range(1, k + 1)] + [F.lead("_x", j).over(w) - F.col("_x") for j in range(1, k + 1)]
    found = halo.withColumn("_gaps", F.array_sort(F.filter(F.array(*gaps), lambda g: g.isNotNull())))
    found = found.where(F.col("_block") == home).withColumn("_k", F.least(F.lit(k), F.col("_size") - 1))
    return found.select("_feature", "_label", "_id", "_x", "_size", "_k", F.get("_gaps", F.col("_k").cast("int") - 1).alias("_radius"))


def mutual_info(df: DataFrame, features: list[str], label: str = "label", k: int = NEIGHBOURS, key: str = "cell_id") -> DataFrame:
    """Mutual information (nats) of each numeric feature with the label, from nearest neighbours.

    A row's radius is the distance to its k-th nearest value among the rows of its class (k less one row's class size if
    that is smaller); m counts the rows of all classes strictly inside the radius, and those of equal value. The estimate is
    digamma(n) + mean digamma(k) - mean digamma(class size) - mean digamma(m), not below 0. Rows with a null or a class of one are
    left out. No noise is added to break ties, so equal values have a radius of 0.

    All features go through each step together: places by range-sorted parts, radii in blocks with k rows of halo, and counts inside
    the radii as differences of running totals where the radii's ends are sorted in among the values.
    """
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("_feature"), F.col(c).cast("double").alias("_x")) for c in features]))
    rows = df.select(F.col(label).alias("_label"), F.col(key).alias("_id"), each).where("_label IS NOT NULL AND _x IS NOT NULL")
    placed = materialize(positions(rows, ["_feature", "_label", "_x", "_id"], "mi-places"), "mi-ranks")
    sizes = placed.groupBy("_feature", "_label").agg(F.count(F.lit(1)).alias("_size"), F.min("_pos").alias("_first")).where("_size > 1")
    ranked = placed.join(F.broadcast(sizes), ["_feature", "_label"]).withColumn("_r", F.col("_pos") - F.col("_first"))  # a row for each feature and class
    radii = materialize(_radii(ranked, k, BLOCK_ROWS), "mi-radii")

    zero = F.col("_radius") == 0
    # at equal values, ends of kind 0 come before the rows (kind 1) and ends of kind 2 after them
    lower = F.struct((F.col("_x") - F.col("_radius")).alias("_v"), F.when(zero, 0).otherwise(2).alias("_kind"), F.lit(-1).alias("_sign"))
    upper = F.struct((F.col("_x") + F.col("_radius")).alias("_v"), F.when(zero, 2).otherwise(0).alias("_kind"), F.lit(1).alias("_sign"))
    value = F.struct(F.col("_x").alias("_v"), F.lit(1).alias("_kind"), F.lit(0).alias("_sign"))
    events = radii.select("_feature", "_id", F.inline(F.array(lower, value, upper))).withColumn("_one", (F.col("_sign") == 0).cast("long"))
    counted = positions(events, ["_feature", "_v", "_kind", "_id"], "mi-events", {"_upto": "_one"})
    inside = counted.where("_sign <> 0").groupBy("_feature", "_id").agg(F.sum(F.col("_sign") * F.col("_upto")).alias("_m"))
    m = inside.groupBy("_feature").agg(F.avg(digamma(F.col("_m"))).alias("_mean_m"))
    own = radii.groupBy("_feature").agg(digamma(F.count(F.lit(1))).alias("_all"), F.avg(digamma(F.col("_k"))).alias("_mean_k"), F.avg(digamma(F.col("_size"))).alias("_mean_size"))
    found = own.join(m, "_feature").select(F.col("_feature").alias("feature"), F.greatest(F.lit(0.0), F.col("_all") + F.col("_mean_k") - F.col("_mean_size") - F.col("_mean_m")).alias("mutual_info"))
    return found.orderBy(F.desc("mutual_info"), "feature")
