"""Preparation queries: imputation, encoding, engineered columns, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEED, TEST_SHARE, VAL_SHARE
from ..functions.seeded import sql_lit as L
from ..functions.seeded import sql_uniform as U
from ..operators import prep, split
from ..sources import fixtures as fx
from .context import Ctx
from .q_labels import LABEL_CTES, VIEWS
from .queries import V, query

R6 = 6


def _cn(c: Ctx) -> DataFrame:
    return fx.customer_with_nulls(c.spark, c.sf_dir)


_MODE_SEG = ("(SELECT c_mktsegment FROM customer_nulls WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment "
             "ORDER BY count(*) DESC, c_mktsegment LIMIT 1)")


@query("impute_mean", V(
    "SELECT c_custkey, c_name, coalesce(CAST(c_nationkey AS DOUBLE), (SELECT avg(c_nationkey) FROM customer_nulls)) "
    "AS c_nationkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM customer_nulls)), 6) AS c_acctbal, "
    f"coalesce(c_mktsegment, {_MODE_SEG}) AS c_mktsegment FROM customer_nulls", "customer_nulls"))
def q_impute_mean(c: Ctx) -> DataFrame:
    """M7 mean: numeric nulls -> mean, other nulls -> mode."""
    return prep.impute(_cn(c), "mean").withColumn("c_acctbal", F.round("c_acctbal", R6))


@query("impute_median", V(
    "SELECT c_custkey, c_name, coalesce(CAST(c_nationkey AS DOUBLE), (SELECT quantile_cont(c_nationkey, 0.5) FROM "
    "customer_nulls)) AS c_nationkey, round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM "
    f"customer_nulls)), 6) AS c_acctbal, coalesce(c_mktsegment, {_MODE_SEG}) AS c_mktsegment FROM customer_nulls",
    "customer_nulls"))
def q_impute_median(c: Ctx) -> DataFrame:
    """M7 median: numeric nulls -> exact median, other nulls -> mode."""
    return prep.impute(_cn(c), "median").withColumn("c_acctbal", F.round("c_acctbal", R6))


@query("impute_mode", V(
    f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, coalesce(c_mktsegment, {_MODE_SEG}) AS c_mktsegment "
    "FROM customer_nulls", "customer_nulls"))
def q_impute_mode(c: Ctx) -> DataFrame:
    """M7 mode: only non-numeric columns are filled."""
    return prep.impute(_cn(c), "mode")


@query("impute_drop", V("SELECT * FROM customer_nulls WHERE c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL "
                        "AND c_mktsegment IS NOT NULL", "customer_nulls"))
def q_impute_drop(c: Ctx) -> DataFrame:
    """M7 drop: rows with any null removed."""
    return prep.impute(_cn(c), "drop")


@query("null_columns", V(
    "SELECT * FROM (SELECT 'c_nationkey' AS column, count(*) FILTER (WHERE c_nationkey IS NULL) AS null_count, "
    "round(count(*) FILTER (WHERE c_nationkey IS NULL) * 100.0 / count(*), 6) AS null_pct FROM customer_nulls "
    "UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_acctbal IS NULL), "
    "round(count(*) FILTER (WHERE c_acctbal IS NULL) * 100.0 / count(*), 6) FROM customer_nulls "
    "UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL), "
    "round(count(*) FILTER (WHERE c_mktsegment IS NULL) * 100.0 / count(*), 6) FROM customer_nulls) t "
    "WHERE null_count > 0", "customer_nulls"))
def q_null_columns(c: Ctx) -> DataFrame:
    """Null count and percent per column (only columns with nulls)."""
    from ..operators.stats import null_report
    return null_report(_cn(c)).withColumn("null_pct", F.round("null_pct", R6))


@query("label_encode", V(
    "SELECT o.o_orderkey, a.code AS o_orderpriority, b.code AS o_orderstatus FROM orders o "
    "JOIN (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT "
    "o_orderpriority AS v FROM orders) x) a ON a.v = o.o_orderpriority "
    "JOIN (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT "
    "o_orderstatus AS v FROM orders) y) b ON b.v = o.o_orderstatus"))
def q_label_encode(c: Ctx) -> DataFrame:
    """M8: sorted-category codes; unseen values raise."""
    o = c.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return prep.label_encode(o, ["o_orderpriority", "o_orderstatus"])


@query("poly_features", V(
    "SELECT p_partkey, round(pow(p_retailprice, 2), 6) AS p_retailprice_pow_2, "
    "round(pow(p_retailprice, 3), 6) AS p_retailprice_pow_3, round(pow(p_size, 2), 6) AS p_size_pow_2, "
    "round(pow(p_size, 3), 6) AS p_size_pow_3 FROM part"))
def q_poly_features(c: Ctx) -> DataFrame:
    """Polynomial columns up to degree 3."""
    p = prep.polynomial_features(c.table("part").select("p_partkey", "p_retailprice", "p_size"),
                                 ["p_retailprice", "p_size"], 3)
    return p.select("p_partkey", *[F.round(x, R6).alias(x) for x in p.columns if "_pow_" in x])


@query("interactions", V("SELECT p_partkey, round(p_size * p_retailprice, 6) AS p_size_x_p_retailprice FROM part"))
def q_interactions(c: Ctx) -> DataFrame:
    """Interaction column a * b."""
    p = prep.interaction_features(c.table("part").select("p_partkey", "p_size", "p_retailprice"),
                                  [("p_size", "p_retailprice")])
    return p.select("p_partkey", F.round("p_size_x_p_retailprice", R6).alias("p_size_x_p_retailprice"))


_BIN_EDGES = " + ".join(
    f"CASE WHEN CAST({j} AS DOUBLE) * st + lo < p_retailprice THEN 1 ELSE 0 END" for j in range(1, 5))


@query("binned", V(
    f"SELECT p_partkey, CAST({_BIN_EDGES} AS INTEGER) AS p_retailprice_binned FROM part, (SELECT lo, (hi - lo) / "
    "CAST(5 AS DOUBLE) AS st FROM (SELECT CASE WHEN min(p_retailprice) = max(p_retailprice) THEN min(p_retailprice) "
    "- CASE WHEN min(p_retailprice) <> 0 THEN abs(min(p_retailprice)) * 0.001 ELSE 0.001 END ELSE "
    "CAST(min(p_retailprice) AS DOUBLE) END AS lo, CASE WHEN min(p_retailprice) = max(p_retailprice) THEN "
    "max(p_retailprice) + CASE WHEN max(p_retailprice) <> 0 THEN abs(max(p_retailprice)) * 0.001 ELSE 0.001 END "
    "ELSE CAST(max(p_retailprice) AS DOUBLE) END AS hi FROM part) a) s"))
def q_binned(c: Ctx) -> DataFrame:
    """C11: equal-width right-closed bin codes (5 bins)."""
    p = prep.binned_feature(c.table("part").select("p_partkey", "p_retailprice"), "p_retailprice", 5)
    return p.select("p_partkey", "p_retailprice_binned")


# ------------------------------------------------------------------ splits --

def _alloc_sql(src: str, share: float, tag: str, prefix: str) -> list[str]:
    """CTEs for one stratified held-out draw over ``src`` (cell_id, label)."""
    return [
        f"{prefix}c AS (SELECT label, count(*) AS c FROM {src} GROUP BY label)",
        (f"{prefix}t AS (SELECT sum(c) AS n, CAST(ceil({L(share)} * CAST(sum(c) AS DOUBLE)) AS BIGINT) AS nh "
         f"FROM {prefix}c)"),
        (f"{prefix}a AS (SELECT k.label, k.c, CAST(k.c AS DOUBLE) / t.n * (t.n - t.nh) AS cont, t.n, t.nh "
         f"FROM {prefix}c k, {prefix}t t)"),
        (f"{prefix}b AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM {prefix}a)"),
        (f"{prefix}d AS (SELECT *, (n - nh) - sum(fl) OVER () AS need, row_number() OVER (ORDER BY rem DESC, label) "
         f"AS rk FROM {prefix}b)"),
        f"{prefix}q AS (SELECT label, c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS q FROM {prefix}d)",
        (f"{prefix}r AS (SELECT s.cell_id, s.label, row_number() OVER (PARTITION BY s.label ORDER BY "
         f"{U(tag, 's.cell_id')}, s.cell_id) - 1 < q.q AS held FROM {src} s JOIN {prefix}q q ON q.label = s.label)"),
    ]


SPLIT_CTES = LABEL_CTES + [
    "ds AS (SELECT f.cell_id, l.label FROM fpop f JOIN lbl l ON l.cell_id = f.cell_id)",
    *_alloc_sql("ds", TEST_SHARE, f"split-test-{SEED}", "s1"),
    "rest AS (SELECT cell_id, label FROM s1r WHERE NOT held)",
    *_alloc_sql("rest", VAL_SHARE / (1 - TEST_SHARE), f"split-val-{SEED}", "s2"),
    ("splits AS (SELECT cell_id, label, 'test' AS split FROM s1r WHERE held UNION ALL SELECT cell_id, label, "
     "CASE WHEN held THEN 'val' ELSE 'train' END FROM s2r)"),
]


def _splits(c: Ctx) -> DataFrame:
    ds = split.merge_features_labels(c.features_pop, c.labels)
    return split.stratified_split(ds.select("cell_id", "label"))


@query("stratified_split", V("SELECT cell_id, label, split FROM splits", *VIEWS, ctes=SPLIT_CTES))
def q_stratified_split(c: Ctx) -> DataFrame:
    """M10 + J10 + M11: exact 70/15/15 stratified split by seeded keys."""
    return _splits(c).select("cell_id", "label", "split")


@query("split_sizes", V("SELECT split, label, count(*) AS n FROM splits GROUP BY split, label", *VIEWS,
                        ctes=SPLIT_CTES))
def q_split_sizes(c: Ctx) -> DataFrame:
    """Rows per split and class."""
    return _splits(c).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@query("split_quality", V(
    "SELECT (SELECT count(*) FROM ds) AS n_original, count(*) AS n_split, "
    "avg(label) FILTER (WHERE split = 'train') AS train_share, avg(label) FILTER (WHERE split = 'val') AS val_share, "
    "avg(label) FILTER (WHERE split = 'test') AS test_share, count(*) = (SELECT count(*) FROM ds) AS is_valid, "
    "abs(avg(label) FILTER (WHERE split = 'train') - avg(label) FILTER (WHERE split = 'val')) < 0.05 AND "
    "abs(avg(label) FILTER (WHERE split = 'train') - avg(label) FILTER (WHERE split = 'test')) < 0.05 AS balance_ok "
    "FROM splits", *VIEWS, ctes=SPLIT_CTES))
def q_split_quality(c: Ctx) -> DataFrame:
    """Q3: sizes add up and class balance is similar across splits."""
    s = _splits(c)
    return split.validate_splits(s, c.features_pop)


@query("random_split", V(
    f"SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {U(f'split-{SEED}', 'o_orderkey')}, o_orderkey) - 1 "
    f"< ceil((SELECT count(*) FROM orders) * {L(0.2)}) THEN 'test' ELSE 'train' END AS split FROM orders"))
def q_random_split(c: Ctx) -> DataFrame:
    """M9: exactly ceil(0.2 n) test rows chosen by seeded key."""
    o = c.table("orders").select("o_orderkey")
    return split.random_split(o, "o_orderkey", 0.2).select("o_orderkey", "split")


@query("merge_row_loss", V(
    "SELECT (SELECT count(*) FROM fpop) AS n_features, (SELECT count(*) FROM fpop f JOIN lbl l ON "
    "l.cell_id = f.cell_id) AS n_merged, (SELECT count(*) FROM fpop) - (SELECT count(*) FROM fpop f JOIN lbl l "
    "ON l.cell_id = f.cell_id) AS rows_lost", *VIEWS, ctes=LABEL_CTES))
def q_merge_row_loss(c: Ctx) -> DataFrame:
    """J10 + Q4: rows lost when features meet labels."""
    merged = split.merge_features_labels(c.features_pop, c.labels)
    return split.merge_row_loss(c.features_pop, merged)

