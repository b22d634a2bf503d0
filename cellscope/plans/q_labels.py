"""Scaling and label queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LabelConfig
from ..functions.seeded import sql_lit as L
from ..functions.seeded import sql_normal, sql_uniform
from ..operators import labels as lb
from ..operators.ranking import exact_quantiles
from .context import Ctx
from .q_census import ID_POP
from .queries import FEATURES_SQL, FEATURE_VIEWS, V, query

CFG = LabelConfig()
W = lb.normalized_weights(CFG.weights)


def _z(c: str) -> str:
    sd = f"stddev_pop({c}) OVER ()"
    return f"({c} - avg({c}) OVER ()) / (CASE WHEN {sd} = 0 THEN CAST(1 AS DOUBLE) ELSE {sd} END) AS {c}_norm"


VIEWS = FEATURE_VIEWS + ("cells_id", "census")
NORM_CTES = [
    f"feat AS ({FEATURES_SQL})",
    (f"fpop AS (SELECT f.*, CAST(coalesce(cp.pop, 0) AS BIGINT) AS population FROM feat f "
     f"JOIN cells_id g ON g.cell_id = f.cell_id LEFT JOIN ({ID_POP}) cp ON cp.ID36 = g.ID36)"),
    (f"fn AS (SELECT *, {_z('stop_count')}, {_z('route_count')}, {_z('daily_trips')}, {_z('population')} "
     f"FROM fpop)"),
    (f"sc AS (SELECT cell_id, population, {L(W['stops'])} * stop_count_norm + {L(W['routes'])} * route_count_norm"
     f" + {L(W['trips'])} * daily_trips_norm AS composite_score FROM fn)"),
]
Z_T = lb.threshold_noise_z(CFG.seed)
LABEL_CTES = NORM_CTES + [
    (f"st AS (SELECT quantile_cont(composite_score, {L(CFG.threshold_quantile)}) AS threshold_used, "
     f"stddev_samp(population) AS pop_sd, stddev_samp(composite_score) AS score_sd, count(*) AS n, "
     f"quantile_cont(population, 0.5) AS population_median FROM sc)"),
    (f"nz AS (SELECT sc.*, st.*, greatest(CAST(0 AS DOUBLE), population + "
     f"{sql_normal(f'pop-noise-{CFG.seed}', 'cell_id')} * ({L(CFG.population_noise_sd)} * pop_sd)) "
     f"AS population_noisy, threshold_used + {L(Z_T)} * ({L(CFG.threshold_noise_sd)} * score_sd) "
     f"AS threshold_noisy FROM sc, st)"),
    "md AS (SELECT quantile_cont(population_noisy, 0.5) AS population_median_noisy FROM nz)",
    (f"lb0 AS (SELECT nz.*, md.*, CASE WHEN composite_score < threshold_noisy AND population_noisy > "
     f"population_median_noisy THEN 0 ELSE 1 END AS label_base, row_number() OVER (ORDER BY "
     f"{sql_uniform(f'flip-{CFG.seed}', 'cell_id')}, cell_id) - 1 AS frank FROM nz, md)"),
    (f"lbl AS (SELECT *, frank < floor(n * {L(CFG.flip_probability)}) AS flipped, CASE WHEN frank < "
     f"floor(n * {L(CFG.flip_probability)}) THEN 1 - label_base ELSE label_base END AS label FROM lb0)"),
]


@query("scaled_features", V(
    "SELECT cell_id, round(stop_count_norm, 6) AS stop_count_norm, round(route_count_norm, 6) AS route_count_norm, "
    "round(daily_trips_norm, 6) AS daily_trips_norm FROM fn", *VIEWS, ctes=NORM_CTES[:3]))
def q_scaled_features(c: Ctx) -> DataFrame:
    """M3: z-scores (population std) of the three transit features."""
    return c.features_norm.select("cell_id", *[F.round(f"{x}_norm", 6).alias(f"{x}_norm")
                                               for x in ("stop_count", "route_count", "daily_trips")])


@query("population_norm", V(
    "SELECT cell_id, population, round(population_norm, 6) AS population_norm FROM fn", *VIEWS,
    ctes=NORM_CTES[:3]))
def q_population_norm(c: Ctx) -> DataFrame:
    """M4 (+ J6/J9): merged population and its z-score."""
    return c.features_pop.select("cell_id", "population", F.round("population_norm", 6).alias("population_norm"))


@query("composite_score", V("SELECT cell_id, round(composite_score, 6) AS composite_score FROM sc", *VIEWS,
                            ctes=NORM_CTES))
def q_composite_score(c: Ctx) -> DataFrame:
    """Weighted composite score."""
    return c.features_norm.select("cell_id", F.round(lb.composite_score(CFG.weights), 6).alias("composite_score"))


@query("threshold", V(f"SELECT round(quantile_cont(composite_score, {L(CFG.threshold_quantile)}), 6) AS threshold "
                      "FROM sc", *VIEWS, ctes=NORM_CTES))
def q_threshold(c: Ctx) -> DataFrame:
    """M12 (A10): exact 0.90 quantile of the score, linear interpolation."""
    df = c.features_norm.select(lb.composite_score(CFG.weights).alias("s"))
    return exact_quantiles(df, "s", [CFG.threshold_quantile], ["threshold"]).select(F.round("threshold", 6)
                                                                                     .alias("threshold"))


@query("labels_score_only", V(
    "SELECT cell_id, round(composite_score, 6) AS composite_score, CASE WHEN composite_score >= t THEN 1 ELSE 0 END "
    f"AS label FROM sc, (SELECT quantile_cont(composite_score, {L(CFG.threshold_quantile)}) AS t FROM sc) q",
    *VIEWS, ctes=NORM_CTES))
def q_labels_score_only(c: Ctx) -> DataFrame:
    """Score-only labels when no population is available."""
    lf = lb.label_frame(c.features_norm, CFG, use_population=False)
    return lf.select("cell_id", F.round("composite_score", 6).alias("composite_score"), "label")


@query("labels_plain", V(
    "SELECT cell_id, CASE WHEN composite_score < threshold_used AND population > population_median THEN 0 "
    "ELSE 1 END AS label FROM sc, st", *VIEWS, ctes=LABEL_CTES[:5]))
def q_labels_plain(c: Ctx) -> DataFrame:
    """M13 with noise off: underserved = low score AND population above median."""
    cfg = LabelConfig(noise=False)
    return lb.label_frame(c.features_pop, cfg).select("cell_id", "label")


@query("labels", V(
    "SELECT cell_id, round(composite_score, 6) AS composite_score, label, round(threshold_used, 6) AS "
    "threshold_used, 'supply-vs-demand' AS labeling_method, population, population_median FROM lbl",
    *VIEWS, ctes=LABEL_CTES))
def q_labels(c: Ctx) -> DataFrame:
    """Labels with population noise, threshold noise and exact-count flips."""
    return c.labels.withColumns({"composite_score": F.round("composite_score", 6),
                                 "threshold_used": F.round("threshold_used", 6)})


@query("label_params", V(
    "SELECT DISTINCT round(threshold_used, 6) AS threshold_used, round(threshold_noisy, 6) AS threshold_noisy, "
    "population_median, round(population_median_noisy, 6) AS population_median_noisy, "
    f"CAST(floor(n * {L(CFG.flip_probability)}) AS BIGINT) AS n_flips FROM lbl", *VIEWS, ctes=LABEL_CTES))
def q_label_params(c: Ctx) -> DataFrame:
    """M16 + M13: stored vs noised threshold and median, number of flips."""
    lf = lb.label_frame(c.features_pop, CFG)
    agg = lf.agg(F.first("threshold_used").alias("t"), F.first("threshold_noisy").alias("tn"),
                 F.first("population_median").alias("population_median"),
                 F.first("population_median_noisy").alias("mn"),
                 F.count(F.when(F.col("flipped"), 1)).alias("n_flips"))
    return agg.select(F.round("t", 6).alias("threshold_used"), F.round("tn", 6).alias("threshold_noisy"),
                      "population_median", F.round("mn", 6).alias("population_median_noisy"), "n_flips")


@query("label_flips", V("SELECT cell_id, label_base, label FROM lbl WHERE flipped", *VIEWS, ctes=LABEL_CTES))
def q_label_flips(c: Ctx) -> DataFrame:
    """Exactly int(n * p) cells flipped, chosen by seeded key."""
    return lb.label_frame(c.features_pop, CFG).filter("flipped").select("cell_id", "label_base", "label")


@query("class_distribution", V(
    "SELECT label, count(*) AS count, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM lbl "
    "GROUP BY label", *VIEWS, ctes=LABEL_CTES))
def q_class_distribution(c: Ctx) -> DataFrame:
    """Label counts and shares."""
    return lb.class_distribution(c.labels)


@query("label_quality", V(
    "SELECT n, mn / CAST(n AS DOUBLE) AS minority_share, ws / CAST(n AS DOUBLE) AS well_served_share, "
    "mn / CAST(n AS DOUBLE) >= 0.05 AS is_valid, abs(ws / CAST(n AS DOUBLE) - 0.1) <= 0.05 AS well_served_ok "
    "FROM (SELECT min(c) AS mn, sum(c) AS n, sum(CASE WHEN label = 1 THEN c ELSE 0 END) AS ws FROM "
    "(SELECT label, count(*) AS c FROM lbl GROUP BY label) x) y", *VIEWS, ctes=LABEL_CTES))
def q_label_quality(c: Ctx) -> DataFrame:
    """Q2: minority share and well-served share checks."""
    return lb.validate_labels(c.labels)


@query("quadrants", V(
    "SELECT q.supply, q.demand, coalesce(k.count, 0) AS count, round(coalesce(k.count, 0) * 100.0 / "
    "(SELECT count(*) FROM lbl), 1) AS percentage FROM (VALUES ('Low', 'Low'), ('Low', 'High'), ('High', 'Low'), "
    "('High', 'High')) q(supply, demand) LEFT JOIN (SELECT CASE WHEN composite_score < threshold_used THEN 'Low' "
    "ELSE 'High' END AS supply, CASE WHEN population > population_median THEN 'High' ELSE 'Low' END AS demand, "
    "count(*) AS count FROM lbl GROUP BY 1, 2) k ON k.supply = q.supply AND k.demand = q.demand",
    *VIEWS, ctes=LABEL_CTES))
def q_quadrants(c: Ctx) -> DataFrame:
    """Supply x demand quadrant counts."""
    return lb.quadrants(c.labels)
