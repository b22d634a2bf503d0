"""Descriptive statistics, each as a few aggregations (A7-A18, W1, P11, P12,
T1-T5).

Results are small frames (one row per column, bin, class or pair); no
operator pulls data rows to the driver. Quantiles are exact
(``exact_quantiles``: distributed ranks, not one sort).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prep import numeric_columns
from .ranking import average_pct_rank, exact_quantiles, ieee_div, multi_quantiles, one_row


def _stack(df: DataFrame, rows: list[tuple[str, list]], names: list[str]) -> DataFrame:
    """One-row wide frame -> one row per entry of ``rows`` (label, exprs); the frame is planned once."""
    entries = [F.struct(F.lit(label).alias(names[0]), *[e.alias(n) for e, n in zip(exprs, names[1:])])
               for label, exprs in rows]
    return df.select(F.inline(F.array(*entries)))


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """Sum, mean, sample std, min, max, median, share of positive values."""
    s = df.agg(F.sum(col).alias("sum"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
               F.min(col).alias("min"), F.max(col).alias("max"),
               F.avg((F.col(col) > 0).cast("double")).alias("share_positive"))
    return s.crossJoin(one_row(exact_quantiles(df, col, [0.5], ["median"])))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Rows per value (nulls excluded), optionally as a share."""
    vc = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return vc
    n = vc.agg(F.sum("count").alias("_n"))
    return vc.crossJoin(one_row(n)).withColumn("share", F.col("count") / F.col("_n")).drop("_n")


def quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """A10: one row per p with the exact linear-interpolated quantile."""
    names = [f"q{i}" for i in range(len(probs))]
    row = exact_quantiles(df, col, probs, names)
    return _stack(row, [(str(p), [F.col(n)]) for p, n in zip(probs, names)], ["p", "value"]).select(
        F.col("p").cast("double").alias("p"), "value")


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, 25%, 50%, 75%, max per numeric column."""
    cols = cols or numeric_columns(df)
    base = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))])
    qs = multi_quantiles(df, [(c, p, f"{c}__q{int(p * 100)}") for c in cols for p in (0.25, 0.5, 0.75)])
    base = base.crossJoin(one_row(qs))
    fields = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    rows = [(c, [F.col(f"{c}__{f}").cast("long" if f == "count" else "double") for f in fields]) for c in cols]
    return _stack(base, rows, ["column"] + fields)


def null_report(df: DataFrame) -> DataFrame:
    """Null count and percent per column, only columns with nulls,
    largest first."""
    s = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns],
               F.count(F.lit(1)).alias("__n"))
    st = _stack(s, [(c, [F.col(c), F.col(c) / F.col("__n") * 100]) for c in df.columns],
                ["column", "null_count", "null_pct"])
    return st.filter("null_count > 0").orderBy(F.desc("null_count"), "column")


def zero_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per feature mean, median, q75, q95, max, zero count and percent."""
    a = df.agg(*[e for c in cols for e in (
        F.avg(c).alias(f"{c}__mean"), F.max(c).cast("double").alias(f"{c}__max"),
        F.sum((F.col(c) == 0).cast("long")).alias(f"{c}__zero_count"),
        (F.avg((F.col(c) == 0).cast("double")) * 100).alias(f"{c}__zero_pct"))])
    q = multi_quantiles(df, [(c, p, f"{c}__{n}") for c in cols for p, n in
                             ((0.5, "median"), (0.75, "q75"), (0.95, "q95"))])
    wide = a.crossJoin(one_row(q))
    fields = ["mean", "median", "q75", "q95", "max", "zero_count", "zero_pct"]
    return _stack(wide, [(c, [F.col(f"{c}__{f}") for f in fields]) for c in cols], ["feature"] + fields)


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max]; bins are left-closed except the
    last; every bin is reported (0 when empty). Edges min + j * (max-min)/bins."""
    s = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    s = s.withColumn("_step", (F.col("_hi") - F.col("_lo")) / bins)
    x = F.col(col)
    code = sum((F.lit(j) * F.col("_step") + F.col("_lo") <= x).cast("int") for j in range(1, bins))
    counts = (df.filter(x.isNotNull()).crossJoin(one_row(s)).select(code.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(one_row(s))
    out = all_bins.join(counts, "bin", "left")
    return out.select("bin", (F.col("bin") * F.col("_step") + F.col("_lo")).alias("lo"),
                      F.when(F.col("bin") == bins - 1, F.col("_hi"))
                      .otherwise((F.col("bin") + 1) * F.col("_step") + F.col("_lo")).alias("hi"),
                      F.coalesce("count", F.lit(0)).alias("count"))


def pearson(a, b):
    """Pearson r over the rows where both are known; NaN when one of them does not vary, null for fewer than two rows."""
    a, b = a.cast("double"), b.cast("double")
    spread = F.sqrt(F.var_samp(F.when(b.isNotNull(), a)) * F.var_samp(F.when(a.isNotNull(), b)))
    return ieee_div(F.covar_samp(a, b), spread)


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for every ordered pair, pairwise-complete, one pass."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    s = df.agg(*[pearson(F.col(a), F.col(b)).alias(f"{a}__{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        rows += [(f"{a}|{b}", [F.col(f"{a}__{b}")]), (f"{b}|{a}", [F.col(f"{a}__{b}")])]
    rows += [(f"{c}|{c}", [F.lit(1.0)]) for c in cols]
    st = _stack(s, rows, ["pair", "corr"])
    return st.select(F.split("pair", r"\|").getItem(0).alias("col_a"), F.split("pair", r"\|").getItem(1)
                     .alias("col_b"), "corr")


def populated(df: DataFrame) -> DataFrame:
    """Cells with population > 0."""
    return df.filter(F.col("population") > 0)


def pop_correlations(df: DataFrame, metrics: list[str]) -> DataFrame:
    """r(population, metric) over populated cells."""
    p = populated(df)
    s = p.agg(*[pearson(F.col("population"), F.col(m)).alias(m) for m in metrics])
    return _stack(s, [(m, [F.col(m)]) for m in metrics], ["metric", "r"])


def trend_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares slope/intercept and the line at ``points`` evenly
    spaced x values between min and max."""
    s = df.agg(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
               F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
               F.min(x).cast("double").alias("_lo"), F.max(x).cast("double").alias("_hi"))
    pts = s.select("slope", "intercept", "_lo", "_hi",
                   F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    xv = F.col("_lo") + F.col("i") * (F.col("_hi") - F.col("_lo")) / (points - 1)
    return pts.select("i", xv.alias("x"), "slope", "intercept").withColumn(
        "y", F.col("slope") * F.col("x") + F.col("intercept"))


def box_stats(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Quartiles, IQR fences, whiskers (most extreme values inside the
    fences), mean, outlier count; per class when ``by`` is given."""
    group = [] if by is None else [by]
    rows = df.select(*group, F.col(col).alias("_x"))
    q = multi_quantiles(rows, [("_x", 0.25, "q1"), ("_x", 0.5, "median"), ("_x", 0.75, "q3")], group)
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")}).withColumns(
        {"lo_fence": F.col("q1") - 1.5 * F.col("iqr"), "hi_fence": F.col("q3") + 1.5 * F.col("iqr")})
    met = rows.join(F.broadcast(q), group) if group else rows.crossJoin(one_row(q))  # a row for each class
    x = F.col("_x")
    a = met.groupBy(*group).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"), F.first("iqr").alias("iqr"),
        F.min(F.when(x >= F.col("lo_fence"), x)).cast("double").alias("whisker_lo"),
        F.max(F.when(x <= F.col("hi_fence"), x)).cast("double").alias("whisker_hi"),
        F.avg(x).alias("mean"),
        F.sum(((x < F.col("lo_fence")) | (x > F.col("hi_fence"))).cast("long")).alias("n_outliers"))
    name = F.col(by).cast("string") if by else F.lit(None).cast("string")
    return a.select(name.alias("group"), *[c for c in a.columns if c not in group])


def outliers(df: DataFrame, col: str) -> DataFrame:
    """Rows outside the 1.5 IQR fences."""
    q = exact_quantiles(df, col, [0.25, 0.75], ["q1", "q3"])
    x = F.col(col)
    iqr = F.col("q3") - F.col("q1")
    return (df.crossJoin(one_row(q))
            .filter((x < F.col("q1") - 1.5 * iqr) | (x > F.col("q3") + 1.5 * iqr)).drop("q1", "q3"))


def pct_rank(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Percent rank with average ties, distributed."""
    return average_pct_rank(df, col, out or f"{col}_pct_rank")


def case_studies(df: DataFrame, transit: str = "daily_trips") -> DataFrame:
    """P11 + T3: top cell of three quantile-bounded groups.

    1. high population (> q75) and low transit (< q25), most populous first;
    2. low population (> 0 and < q25) and low transit (< q25), least populous;
    3. high population (> q75) and high transit (> q75), most populous first.
    Quantiles include zero-population cells.
    """
    q = multi_quantiles(df, [("population", 0.25, "p25"), ("population", 0.75, "p75"),
                             (transit, 0.25, "t25"), (transit, 0.75, "t75")])
    d = df.crossJoin(one_row(q))
    p, t = F.col("population"), F.col(transit)
    cases = [
        ("high_pop_low_transit", (p > F.col("p75")) & (t < F.col("t25")), [F.desc("population"), "cell_id"]),
        ("low_pop_low_transit", (p > 0) & (p < F.col("p25")) & (t < F.col("t25")), [F.asc("population"), "cell_id"]),
        ("high_pop_high_transit", (p > F.col("p75")) & (t > F.col("t75")), [F.desc("population"), "cell_id"]),
    ]
    parts = []
    for name, cond, order in cases:
        parts.append(d.filter(cond).orderBy(*order).limit(1)
                     .select(F.lit(name).alias("case"), "cell_id", "population", transit))
    return reduce(DataFrame.unionByName, parts)


def top_k(df: DataFrame, col: str, k: int, key: str) -> DataFrame:
    """The k largest by ``col`` (ties by ``key``) via TakeOrderedAndProject."""
    return df.orderBy(F.desc(col), F.asc(key)).limit(k)


def top_values(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """T5: the k most frequent values of each column."""
    parts = []
    for c in cols:
        vc = df.groupBy(c).agg(F.count(F.lit(1)).alias("count")).filter(F.col(c).isNotNull())
        parts.append(vc.orderBy(F.desc("count"), F.asc(c)).limit(k)
                     .select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), "count"))
    return reduce(DataFrame.unionByName, parts)
