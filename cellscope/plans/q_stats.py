"""Descriptive-statistics queries over driver tables and the cell features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import stats as st
from .context import Ctx
from .q_labels import LABEL_CTES, VIEWS
from .queries import V, query

R6 = 6
_rnd = lambda df, cols: df.withColumns({c: F.round(c, R6) for c in cols})
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("column_stats", V(
    "SELECT round(sum(l_quantity), 6) AS sum, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) "
    "AS std, min(l_quantity) AS min, max(l_quantity) AS max, round(avg(CASE WHEN l_quantity > 0 THEN 1.0 ELSE 0.0 "
    "END), 6) AS share_positive, quantile_cont(l_quantity, 0.5) AS median FROM lineitem"))
def q_column_stats(c: Ctx) -> DataFrame:
    """Sum, mean, std, min, max, median, share over a column."""
    return _rnd(st.column_stats(c.table("lineitem"), "l_quantity"), ["sum", "mean", "std", "share_positive"])


@query("duplicate_keys", V(
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"))
def q_duplicate_keys(c: Ctx) -> DataFrame:
    """(l_orderkey, l_linenumber) pairs that repeat."""
    return st.duplicates(c.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("value_counts", V(
    "SELECT o_orderpriority, count(*) AS count, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share "
    "FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority"))
def q_value_counts(c: Ctx) -> DataFrame:
    """Value counts with shares."""
    return st.value_counts(c.table("orders"), "o_orderpriority", normalize=True)


_QP = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query("quantiles", V(" UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(p_retailprice, {p}), 6) AS value FROM part" for p in _QP)))
def q_quantiles(c: Ctx) -> DataFrame:
    """A10: exact quantiles with linear interpolation."""
    return _rnd(st.quantiles(c.table("part"), "p_retailprice", _QP), ["value"])


def _describe_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS column, count({x}) AS count, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, "
        f"CAST(min({x}) AS DOUBLE) AS min, round(quantile_cont({x}, 0.25), 6) AS q25, "
        f"round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75, "
        f"CAST(max({x}) AS DOUBLE) AS max FROM {table}" for x in cols)


@query("describe", V(_describe_sql("lineitem", LI_NUM)))
def q_describe(c: Ctx) -> DataFrame:
    """Count, mean, std, min, quartiles, max per numeric column."""
    return _rnd(st.describe(c.table("lineitem"), LI_NUM), ["mean", "std", "q25", "q50", "q75"])


def _hist_sql(table: str, col: str, bins: int) -> str:
    code = " + ".join(f"CASE WHEN CAST({j} AS DOUBLE) * s.st + s.lo <= {col} THEN 1 ELSE 0 END" for j in range(1, bins))
    return (f"WITH s AS (SELECT lo, hi, (hi - lo) / CAST({bins} AS DOUBLE) AS st FROM (SELECT CAST(min({col}) AS DOUBLE)"
            f" AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM {table}) a), "
            f"k AS (SELECT CAST({code} AS INTEGER) AS bin, count(*) AS n FROM {table}, s WHERE {col} IS NOT NULL "
            f"GROUP BY 1) "
            f"SELECT CAST(b.range AS INTEGER) AS bin, round(CAST(b.range AS DOUBLE) * s.st + s.lo, 6) AS lo, "
            f"round(CASE WHEN b.range = {bins - 1} THEN s.hi ELSE CAST(b.range + 1 AS DOUBLE) * s.st + s.lo END, 6) "
            f"AS hi, coalesce(k.n, 0) AS count FROM range({bins}) b CROSS JOIN s LEFT JOIN k ON k.bin = b.range")


@query("histogram", _hist_sql("lineitem", "l_extendedprice", 50))
def q_histogram(c: Ctx) -> DataFrame:
    """50 equal-width bins, last bin closed."""
    return _rnd(st.histogram(c.table("lineitem"), "l_extendedprice", 50), ["lo", "hi"])


@query("corr_matrix", V(" UNION ALL ".join(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
     for a in LI_NUM for b in LI_NUM if a != b]
    + [f"SELECT '{a}', '{a}', CAST(1 AS DOUBLE)" for a in LI_NUM])))
def q_corr_matrix(c: Ctx) -> DataFrame:
    """Pearson correlation matrix."""
    return _rnd(st.corr_matrix(c.table("lineitem"), LI_NUM), ["corr"])


# --------------------------------------------------- over the cell features --

GRID_METRICS = ["stop_count", "route_count", "daily_trips"]


@query("zero_profile", V(" UNION ALL ".join(
    f"SELECT '{x}' AS feature, round(avg({x}), 6) AS mean, round(quantile_cont({x}, 0.5), 6) AS median, "
    f"round(quantile_cont({x}, 0.75), 6) AS q75, round(quantile_cont({x}, 0.95), 6) AS q95, CAST(max({x}) AS DOUBLE) "
    f"AS max, count(*) FILTER (WHERE {x} = 0) AS zero_count, round(avg(CASE WHEN {x} = 0 THEN 1.0 ELSE 0.0 END) "
    f"* 100, 6) AS zero_pct FROM fpop" for x in GRID_METRICS + ["population"]), *VIEWS, ctes=LABEL_CTES[:2]))
def q_zero_profile(c: Ctx) -> DataFrame:
    """Sparsity profile of the cell features."""
    return _rnd(st.zero_profile(c.features_pop, GRID_METRICS + ["population"]),
                ["mean", "median", "q75", "q95", "zero_pct"])


@query("pop_corr", V(" UNION ALL ".join(
    f"SELECT '{x}' AS metric, round(corr(population, {x}), 6) AS r FROM fpop WHERE population > 0"
    for x in GRID_METRICS), *VIEWS, ctes=LABEL_CTES[:2]))
def q_pop_corr(c: Ctx) -> DataFrame:
    """A16 + P12: population vs transit metrics over populated cells."""
    return _rnd(st.pop_correlations(c.features_pop, GRID_METRICS), ["r"])


@query("trend_line", V(
    "SELECT CAST(i.range AS INTEGER) AS i, round(lo + CAST(i.range AS DOUBLE) * (hi - lo) / 99, 6) AS x, "
    "round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(slope * (lo + CAST(i.range AS DOUBLE) * "
    "(hi - lo) / 99) + intercept, 6) AS y FROM range(100) i, (SELECT regr_slope(daily_trips, population) AS slope, "
    "regr_intercept(daily_trips, population) AS intercept, CAST(min(population) AS DOUBLE) AS lo, "
    "CAST(max(population) AS DOUBLE) AS hi FROM fpop) s", *VIEWS, ctes=LABEL_CTES[:2]))
def q_trend_line(c: Ctx) -> DataFrame:
    """Least-squares trend of daily trips on population, 100 points."""
    return _rnd(st.trend_line(c.features_pop, "population", "daily_trips").withColumn("i", F.col("i").cast("int")),
                ["x", "slope", "intercept", "y"])


@query("box_stats", V(
    "SELECT CAST(label AS VARCHAR) AS \"group\", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
    "round(q3 - q1, 6) AS iqr, CAST(min(daily_trips) FILTER (WHERE daily_trips >= q1 - 1.5 * (q3 - q1)) AS DOUBLE) "
    "AS whisker_lo, CAST(max(daily_trips) FILTER (WHERE daily_trips <= q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_hi, "
    "round(avg(daily_trips), 6) AS mean, count(*) FILTER (WHERE daily_trips < q1 - 1.5 * (q3 - q1) OR daily_trips > "
    "q3 + 1.5 * (q3 - q1)) AS n_outliers FROM (SELECT f.daily_trips, l.label, quantile_cont(f.daily_trips, 0.25) "
    "OVER (PARTITION BY l.label) AS q1, quantile_cont(f.daily_trips, 0.5) OVER (PARTITION BY l.label) AS median, "
    "quantile_cont(f.daily_trips, 0.75) OVER (PARTITION BY l.label) AS q3 FROM fpop f JOIN lbl l "
    "ON l.cell_id = f.cell_id) t GROUP BY label, q1, median, q3", *VIEWS, ctes=LABEL_CTES))
def q_box_stats(c: Ctx) -> DataFrame:
    """Box-plot statistics of daily trips by class."""
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    return _rnd(st.box_stats(d, "daily_trips", by="label"), ["q1", "median", "q3", "iqr", "mean"])


@query("outliers", V(
    "SELECT cell_id, daily_trips FROM fpop, (SELECT quantile_cont(daily_trips, 0.25) AS q1, "
    "quantile_cont(daily_trips, 0.75) AS q3 FROM fpop) q WHERE daily_trips < q1 - 1.5 * (q3 - q1) OR "
    "daily_trips > q3 + 1.5 * (q3 - q1)", *VIEWS, ctes=LABEL_CTES[:2]))
def q_outliers(c: Ctx) -> DataFrame:
    """Cells outside the 1.5 IQR fences of daily trips."""
    return st.outliers(c.features_pop.select("cell_id", "daily_trips"), "daily_trips")


@query("pct_rank", V(
    "SELECT cell_id, round((rank() OVER (ORDER BY daily_trips) + (count(*) OVER (PARTITION BY daily_trips) - 1) "
    "/ 2.0) / count(*) OVER (), 6) AS daily_trips_pct_rank FROM fpop", *VIEWS, ctes=LABEL_CTES[:2]))
def q_pct_rank(c: Ctx) -> DataFrame:
    """Percent rank with averaged ties."""
    return _rnd(st.pct_rank(c.features_pop.select("cell_id", "daily_trips"), "daily_trips"),
                ["daily_trips_pct_rank"]).select("cell_id", "daily_trips_pct_rank")


@query("case_studies", V(
    "SELECT * FROM (SELECT 'high_pop_low_transit' AS \"case\", cell_id, population, daily_trips FROM fpop, q "
    "WHERE population > p75 AND daily_trips < t25 ORDER BY population DESC, cell_id LIMIT 1) a UNION ALL "
    "SELECT * FROM (SELECT 'low_pop_low_transit', cell_id, population, daily_trips FROM fpop, q WHERE population > 0 "
    "AND population < p25 AND daily_trips < t25 ORDER BY population, cell_id LIMIT 1) b UNION ALL "
    "SELECT * FROM (SELECT 'high_pop_high_transit', cell_id, population, daily_trips FROM fpop, q WHERE "
    "population > p75 AND daily_trips > t75 ORDER BY population DESC, cell_id LIMIT 1) c", *VIEWS,
    ctes=LABEL_CTES[:2] + ["q AS (SELECT quantile_cont(population, 0.25) AS p25, quantile_cont(population, 0.75) "
                           "AS p75, quantile_cont(daily_trips, 0.25) AS t25, quantile_cont(daily_trips, 0.75) AS t75 "
                           "FROM fpop)"]))
def q_case_studies(c: Ctx) -> DataFrame:
    """P11 + T3: the top cell of three supply/demand case groups."""
    return st.case_studies(c.features_pop)


@query("top_cells", V("SELECT cell_id, daily_trips FROM fpop ORDER BY daily_trips DESC, cell_id LIMIT 10",
                      *VIEWS, ctes=LABEL_CTES[:2]))
def q_top_cells(c: Ctx) -> DataFrame:
    """T1 + T2: the ten busiest cells (a top-k report)."""
    return st.top_k(c.features_pop.select("cell_id", "daily_trips"), "daily_trips", 10, "cell_id")


@query("top_values", V(" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{x}' AS column, CAST({x} AS VARCHAR) AS value, count(*) AS count FROM orders WHERE {x} "
    f"IS NOT NULL GROUP BY {x} ORDER BY count(*) DESC, {x} LIMIT 10) t{i}"
    for i, x in enumerate(["o_orderstatus", "o_orderpriority", "o_custkey"]))))
def q_top_values(c: Ctx) -> DataFrame:
    """T5: ten most frequent values per categorical column."""
    return st.top_values(c.table("orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


# ------------------------------------------------------- feature scoring ---

SEL = ["stop_count", "route_count", "daily_trips", "population"]
_SEL_DS = "ds AS (SELECT f.*, l.label FROM fpop f JOIN lbl l ON l.cell_id = f.cell_id)"


def _anova_sql(c: str) -> str:
    return (f"SELECT '{c}' AS feature, round(((B - S * S / n) / (k - 1)) / ((Q - B) / (n - k)), 6) AS f_score FROM "
            f"(SELECT sum(cn) AS n, count(*) AS k, sum(s) AS S, sum(q) AS Q, sum(s * s / cn) AS B FROM "
            f"(SELECT label, count(*) AS cn, sum(CAST({c} AS DOUBLE)) AS s, sum(CAST({c} AS DOUBLE) * "
            f"CAST({c} AS DOUBLE)) AS q FROM ds GROUP BY label) g) t")


@query("anova_f", V(" UNION ALL ".join(_anova_sql(x) for x in SEL), *VIEWS, ctes=LABEL_CTES + [_SEL_DS]))
def q_anova_f(c: Ctx) -> DataFrame:
    """ANOVA F of each cell feature against the label."""
    from ..operators.selection import anova_f
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    return _rnd(anova_f(d, SEL), ["f_score"])


@query("top_k_features", V(
    "SELECT feature, f_score FROM (" + " UNION ALL ".join(_anova_sql(x) for x in SEL) + ") a "
    "ORDER BY f_score DESC, feature LIMIT 2", *VIEWS, ctes=LABEL_CTES + [_SEL_DS]))
def q_top_k_features(c: Ctx) -> DataFrame:
    """The two best features by ANOVA F."""
    from ..operators.selection import select_k_best
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    return _rnd(select_k_best(d, SEL, k=2), ["f_score"])


def _mi_sql(c: str) -> str:
    b = (f"CASE WHEN (mx - mn) / 10.0 = 0 THEN 0 ELSE least(floor(({c} - mn) / ((mx - mn) / CAST(10 AS DOUBLE))), 9) "
         f"END")
    return (f"SELECT '{c}' AS feature, round(sum(cc / CAST(n AS DOUBLE) * ln(cc * CAST(n AS DOUBLE) / (cb * cy))), 6) "
            f"AS mutual_info FROM (SELECT b, y, cc, n, sum(cc) OVER (PARTITION BY b) AS cb, sum(cc) OVER "
            f"(PARTITION BY y) AS cy FROM (SELECT {b} AS b, label AS y, count(*) AS cc, n FROM ds, (SELECT "
            f"CAST(min({c}) AS DOUBLE) AS mn, CAST(max({c}) AS DOUBLE) AS mx, count(*) AS n FROM ds) s "
            f"GROUP BY 1, 2, n) j) t")


@query("mutual_info_binned", V(" UNION ALL ".join(_mi_sql(x) for x in SEL), *VIEWS, ctes=LABEL_CTES + [_SEL_DS]))
def q_mutual_info_binned(c: Ctx) -> DataFrame:
    """M20 (MI variant): binned mutual information with the label."""
    from ..operators.selection import mutual_info_binned
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    return _rnd(mutual_info_binned(d, SEL), ["mutual_info"])


def _digamma_sql(n: str) -> str:
    y = f"({n} + CAST(8 AS DOUBLE))"
    return f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * pow({y}, 2)) + 1 / (120 * pow({y}, 4)) - 1 / (252 * pow({y}, 6)) - " + " - ".join(f"1 / ({n} + CAST({j} AS DOUBLE))" for j in range(8)) + ")"


def _knn_mi_sql(c: str, k: int = 3) -> str:
    """Every row against every row."""
    return (f"SELECT '{c}' AS feature, round(greatest(0, {_digamma_sql('n')} + mk - ms - mm), 6) AS mutual_info FROM (SELECT count(*) AS n, avg({_digamma_sql('k')}) AS mk, "
            f"avg({_digamma_sql('s')}) AS ms, avg({_digamma_sql('m')}) AS mm FROM (SELECT r.cell_id, r.s, r.k, count(*) AS m FROM (SELECT a.cell_id, CAST(a.{c} AS DOUBLE) AS x, z.s, "
            f"least({k}, z.s - 1) AS k, list_extract(min(abs(CAST(b.{c} AS DOUBLE) - CAST(a.{c} AS DOUBLE)), {k}), CAST(least({k}, z.s - 1) AS BIGINT)) AS d FROM ds a JOIN ds b ON a.label = b.label AND a.cell_id <> b.cell_id "
            f"JOIN (SELECT label, count(*) AS s FROM ds GROUP BY label) z ON z.label = a.label WHERE z.s > 1 GROUP BY a.cell_id, a.{c}, z.s) r "
            f"JOIN (SELECT CAST({c} AS DOUBLE) AS y FROM ds) o ON (o.y < r.x + r.d AND o.y > r.x - r.d) OR o.y = r.x GROUP BY r.cell_id, r.s, r.k) g) t")


@query("mutual_info", V(" UNION ALL ".join(_knn_mi_sql(x) for x in SEL), *VIEWS, ctes=LABEL_CTES + ["ds AS MATERIALIZED (SELECT f.*, l.label FROM fpop f JOIN lbl l ON l.cell_id = f.cell_id)"]))
def q_mutual_info(c: Ctx) -> DataFrame:
    """M20 (MI variant): nearest-neighbour mutual information of each cell feature with the label."""
    from ..operators.selection import mutual_info
    d = c.features_pop.join(c.labels.select("cell_id", "label"), "cell_id")
    return _rnd(mutual_info(d, SEL), ["mutual_info"])
