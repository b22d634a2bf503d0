"""Distributed ranks, exact quantiles and exact-count selection (D-RANK).

No operator here uses a Window without a partition over the data itself:
a global order is split into range buckets, only the small per-bucket count
table is ordered globally, and rows are numbered inside their bucket.

* ``hash_rank``: rank by a uniform seeded key (splits, label flips). Buckets
  are fixed-width slices of [0, 1), so they are balanced by construction.
* ``value_ranks``: for a numeric column, each distinct value with its count
  and the number of smaller values. Duplicates collapse first (a value held
  by a third of the rows becomes one row); distinct values are bucketed by
  approximate quantile cut points.
* ``at_ranks``: the values at a few ranks, by histogram refinement (quantiles, exact-count selection); rows far from
  the wanted ranks are only counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def one_row(df: DataFrame) -> DataFrame:
    """Mark a one-row statistics frame for broadcast (its size is one row)."""
    return F.broadcast(df)


def ieee_div(a, b) -> Column:
    """``a / b`` as IEEE doubles, as SQL engines without ANSI errors return it: over 0 an infinity, or NaN for 0 / 0 and NaN."""
    a, b = a.cast("double"), b.cast("double")
    over_zero = F.when(a > 0, float("inf")).when(a < 0, float("-inf")).otherwise(float("nan"))
    return F.when(b == 0, F.when(F.isnan(a), float("nan")).when(a.isNotNull(), over_zero)).otherwise(a / F.nullif(b, F.lit(0.0)))


def with_bucket(df: DataFrame, value: str, cuts: str, out: str = "_bk", max_cuts: int = 255) -> DataFrame:
    """Number of cut points strictly below ``value`` (``cuts`` sorted
    ascending, at most ``max_cuts`` of them) by binary search: one projection
    per halving step, so a lookup costs log2(max_cuts) comparisons."""
    out_df = df.withColumn(out, F.lit(0))
    step = 1 << (max_cuts.bit_length() - 1)
    while step >= 1:
        probe = F.get(F.col(cuts), F.col(out) + (step - 1))  # null past the end
        out_df = out_df.withColumn(out, F.col(out) + F.when(probe < F.col(value), F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return out_df


def hash_rank(df: DataFrame, key: str, group: list[str] | None = None, tiebreak: list[str] | None = None,
              buckets: int = 1024, out: str = "_rank") -> DataFrame:
    """0-based rank of each row inside ``group`` ordered by (key, tiebreak).

    ``key`` must be a double in [0, 1). Bucket offsets come from a
    (group x bucket) count table, which is small and bounded by the number of
    groups times ``buckets``.
    """
    group = list(group or [])
    tiebreak = list(tiebreak or [])
    b = F.least(F.floor(F.col(key) * buckets), F.lit(buckets - 1)).cast("int")
    data = df.withColumn("_bk", b)
    counts = data.groupBy(*group, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(w), F.lit(0))).drop("_bn")
    data = data.join(offs, group + ["_bk"])
    wr = Window.partitionBy(*group, "_bk").orderBy(key, *tiebreak)
    return data.withColumn(out, F.col("_off") + F.row_number().over(wr) - 1).drop("_bk", "_off")


def value_ranks(df: DataFrame, col: str, buckets: int = 256, accuracy: int = 10000) -> DataFrame:
    """Distinct non-null values of ``col`` with ``cnt``, ``n_less`` and total ``n``."""
    vc = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    probs = [i / buckets for i in range(1, buckets)]
    cuts = vc.agg(F.percentile_approx(col, probs, accuracy).alias("_cuts"),
                  F.sum("cnt").alias("n"))
    data = with_bucket(vc.crossJoin(one_row(cuts)), col, "_cuts").drop("_cuts")
    per_bucket = data.groupBy("_bk").agg(F.sum("cnt").alias("_bn"))
    w = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # <= buckets rows
    offs = per_bucket.withColumn("_off", F.coalesce(F.sum("_bn").over(w), F.lit(0))).drop("_bn")
    data = data.join(one_row(offs), "_bk")
    wl = Window.partitionBy("_bk").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    data = data.withColumn("n_less", F.col("_off") + F.coalesce(F.sum("cnt").over(wl), F.lit(0)))
    return data.select(col, "cnt", "n_less", "n")


#: Cut points of a bucket at each level of refinement: what is ranked at the end is about 1 / (CUTS + 1) ** levels of
#: the rows for each wanted rank.
CUTS, CUT_ACCURACY = 255, 1024
#: Estimated bytes of the tables read from which one level, and from which two levels, come before the ranking.
ONE_LEVEL_BYTES, TWO_LEVEL_BYTES = 1 << 20, 16 << 30


def _levels(df: DataFrame) -> int:
    """Levels for the planner's estimate of the tables that are read (the result is the same with any number)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return (size >= ONE_LEVEL_BYTES) + (size >= TWO_LEVEL_BYTES)


def _met(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    return left.join(right, on, how) if on else left.join(right, F.lit(True), how)


def at_ranks(rows: DataFrame, ranks: DataFrame, group: list[str], value: str = "_v") -> DataFrame:
    """The values at given ranks, by histogram refinement: ``group``, _k, the value, _less (rows before that value).

    ``rows`` holds ``group`` and ``value`` (no nulls), ``ranks`` holds ``group`` and _k (0-based; few rows). Each level
    takes approximate cut points from a sketch, counts rows for each bucket exactly, and goes on with the rows of
    the buckets that hold a wanted rank; the values of these alone are shuffled and ranked. All groups and ranks
    share each pass, and no job runs before the result is asked for.
    """
    ranks, levels = F.broadcast(ranks), _levels(rows)
    rows = rows.select(*group, F.col(value).alias("_v")).withColumn("_before", F.lit(0).cast("long"))
    probs = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    at = list(group)
    for level in range(levels):
        cuts = rows.groupBy(*at, "_before").agg(F.percentile_approx("_v", probs, CUT_ACCURACY).alias("_cuts"))
        placed = with_bucket(_met(rows, F.broadcast(cuts.drop("_before")), at), "_v", "_cuts")  # a row for each group or wanted bucket
        counted = placed.groupBy(*at, "_before", "_bk").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = Window.partitionBy(*at).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # at most CUTS + 1 rows
        counted = counted.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
        wanted = _met(counted, ranks, group).where("_before <= _k AND _k < _before + _c")
        wanted = wanted.select(*at, "_before", "_lo", "_hi", F.col("_bk").alias(f"_b{level}")).distinct()
        rows = _met(rows.drop("_before"), F.broadcast(wanted), at).where("_v BETWEEN _lo AND _hi").drop("_lo", "_hi")
        at.append(f"_b{level}")
    counted = rows.groupBy(*at, "_before", "_v").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*at).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_less", F.col("_before") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    return _met(counted, ranks, group).where("_less <= _k AND _k < _less + _c").select(*group, "_k", F.col("_v").alias(value), "_less")


def multi_quantiles(df: DataFrame, specs: list[tuple[str, float, str]], by: list[str] | None = None) -> DataFrame:
    """Several exact quantiles (linear interpolation between the two nearest ranks, position p * (n - 1)) of several
    columns, in one refinement; one row, or one for each value of the columns ``by`` (rows without one are left out).

    ``specs`` holds (column, p, output name). The columns are stacked into (key, value) rows.
    """
    by = list(by or [])
    cols = list(dict.fromkeys(c for c, _, _ in specs))
    each = F.array(*[F.struct(F.lit(i).alias("_key"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)])
    stacked = df.select(*by, F.inline(each)).where("_v IS NOT NULL")
    n = stacked.groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_n"))

    def position(p):
        return F.lit(float(p)) * (F.col("_n") - 1)

    mine = [F.array(*[f(position(p)).cast("long") for c, p, _ in specs if c == name for f in (F.floor, F.ceil)]) for name in cols]
    ranks = n.select(*by, "_key", F.explode(F.array_distinct(F.element_at(F.array(*mine), F.col("_key") + 1))).alias("_k"))
    found = at_ranks(stacked, ranks, [*by, "_key"]).join(F.broadcast(n), [*by, "_key"])  # a row for each column and group
    aggs = []
    for c, p, name in specs:
        key, h = F.col("_key") == cols.index(c), position(p)
        aggs += [F.max(F.when(key & (F.col("_k") == F.floor(h)), F.col("_v"))).alias(f"_{name}_lo"),
                 F.max(F.when(key & (F.col("_k") == F.ceil(h)), F.col("_v"))).alias(f"_{name}_hi"),
                 F.max(F.when(key, h - F.floor(h))).alias(f"_{name}_t")]
    row = found.groupBy(*by).agg(*aggs) if by else found.agg(*aggs)
    return row.select(*by, *[
        (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_t")).alias(n)
        for _, _, n in specs])


def exact_quantiles(df: DataFrame, col: str, probs: list[float], names: list[str] | None = None) -> DataFrame:
    """One row with the exact quantile of ``col`` for each p in ``probs``."""
    names = names or [f"q{i}" for i in range(len(probs))]
    return multi_quantiles(df, [(col, p, n) for p, n in zip(probs, names)])


#: Rows of a range-sorted part.
PART_ROWS = 1_000_000


def positions(df: DataFrame, order: list[str], name: str, sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` written in the order of ``order``, with _pos (0-based place over all rows) and, for each of ``sums`` (output:
    column), the total of that column up to and with the row.

    Parts are ranges of the order, so rows that share the first columns spread over many parts when later ones tell
    them apart; only one row for each part is brought to the driver.
    """
    sums = sums or {}
    parts = max(1, -(-df.count() // PART_ROWS))
    part, row = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", part).withColumn("_row", row)
    placed = materialize(placed, name)
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(o) for o, c in sums.items()]).orderBy("_part").collect()
    starts, before = [], [0] * (1 + len(sums))
    for t in totals:
        starts.append((t["_part"], *before))
        before = [b + (t[k] or 0) for b, k in zip(before, ["_n", *sums])]
    fields = ", ".join(["_part int", "_start long", *(f"_s_{o} long" for o in sums)])
    starts = df.sparkSession.createDataFrame(starts, fields)
    upto = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(starts), "_part")
    return out.select(*df.columns, (F.col("_start") + F.col("_row")).alias("_pos"),
                      *[(F.col(f"_s_{o}") + F.sum(c).over(upto)).alias(o) for o, c in sums.items()])


def take_smallest(df: DataFrame, key: str, quota: DataFrame, group: list[str], tiebreak: str, out: str,
                  keys: DataFrame | None = None) -> DataFrame:
    """Flag ``out`` on the ``_q`` rows of each group (``quota``: group, _q; few rows) with the smallest (key, tiebreak).

    Only the key at the quota's rank is looked for; rows are not ranked. ``key`` is a seeded 32-bit uniform, so the rows
    that share the last key, which alone are put in order, are about one in four thousand million. ``keys`` may give
    the same group, key and tiebreak values from a cheaper plan than that of ``df``.
    """
    keys = df if keys is None else keys
    quota = F.broadcast(quota.where("_q > 0"))
    last = at_ranks(keys.select(*group, key), quota.select(*group, (F.col("_q") - 1).alias("_k")), group, key)
    last = F.broadcast(_met(last, quota, group).select(*group, F.col(key).alias("_last"), (F.col("_q") - F.col("_less")).alias("_more")))
    ties = _met(keys.select(*group, key, tiebreak), last, group).where(F.col(key) == F.col("_last")).select(*group, F.col(tiebreak).alias("_tied"), "_more")
    ties = ties.withColumn("_place", F.row_number().over(Window.partitionBy(*(group or [F.lit(0)])).orderBy("_tied")))
    ties = F.broadcast(ties.where("_place <= _more").select("_tied"))
    return _met(df, last, group, "left").join(ties, F.col(tiebreak) == F.col("_tied"), "left").withColumn(
        out, F.coalesce(F.col(key) < F.col("_last"), F.lit(False)) | F.col("_tied").isNotNull()).drop("_last", "_more", "_tied")


def average_pct_rank(df: DataFrame, col: str, out: str = "pct_rank") -> DataFrame:
    """Percent rank with ties averaged (rank(pct=True)): (n_less + (cnt+1)/2) / n.

    Rows meet the distinct-value table by an equi-join on the value; a hot
    value is one row on that side, and AQE splits the skewed partition."""
    vr = value_ranks(df, col)
    pr = vr.select(col, ((F.col("n_less") + (F.col("cnt") + 1) / 2) / F.col("n")).alias(out))
    return df.join(pr, col, "left")
