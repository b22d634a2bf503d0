"""Supply-vs-demand labels with seeded noise.

Everything is one lazy plan: thresholds, medians and standard deviations
are one-row frames joined by broadcast; noise comes from seeded hashes of
(seed, cell_id), so labels do not depend on partitioning; the flipped cells
are the int(n * p) smallest seeded keys (``take_smallest``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MIN_MINORITY_SHARE, TARGET_WELL_SERVED_SHARE, LabelConfig
from ..functions.seeded import py_normal, seeded_normal, seeded_uniform
from .census import require_columns
from .ranking import exact_quantiles, multi_quantiles, one_row, take_smallest

NORM_COLS = ["stop_count_norm", "route_count_norm", "daily_trips_norm"]


def normalized_weights(weights: dict) -> dict:
    """Weights rescaled to sum to 1 when they do not (pure; input untouched)."""
    total = sum(weights.values())
    if math.isclose(total, 1.0, rel_tol=1e-5, abs_tol=1e-8):
        return dict(weights)
    return {k: v / total for k, v in weights.items()}


def composite_score(weights: dict | None = None):
    """w_stops * stop_count_norm + w_routes * route_count_norm + w_trips * daily_trips_norm."""
    w = normalized_weights(weights or LabelConfig().weights)
    return (F.lit(w["stops"]) * F.col("stop_count_norm") + F.lit(w["routes"]) * F.col("route_count_norm")
            + F.lit(w["trips"]) * F.col("daily_trips_norm"))


def threshold_noise_z(seed: int) -> float:
    """The one Gaussian draw of the threshold noise (M16), fixed by the seed."""
    return py_normal("threshold-noise", seed)


def label_frame(features: DataFrame, cfg: LabelConfig = LabelConfig(), use_population: bool | None = None) -> DataFrame:
    """All label inputs and outcomes per cell.

    Columns: cell_id, composite_score, population, population_noisy,
    threshold_used, threshold_noisy, population_median,
    population_median_noisy, label_base, flipped, label, labeling_method.
    """
    require_columns(features, ["cell_id"] + NORM_COLS, "features")
    has_pop = "population" in features.columns if use_population is None else use_population
    df = features.select("cell_id", *(["population"] if has_pop else []),
                         composite_score(cfg.weights).alias("composite_score"))
    if not has_pop:
        thr = exact_quantiles(df, "composite_score", [cfg.threshold_quantile], ["threshold_used"])
        out = df.crossJoin(one_row(thr))
        return out.withColumns({
            "label": (F.col("composite_score") >= F.col("threshold_used")).cast("int"),
            "labeling_method": F.lit("score-only"),
        })
    noise_on = cfg.noise
    sds = df.agg(F.stddev_samp("population").alias("_pop_sd"), F.stddev_samp("composite_score").alias("_score_sd"),
                 F.count(F.lit(1)).alias("_n"))
    # the score threshold and the raw median share one ranking pass
    thr_med = multi_quantiles(df, [("composite_score", cfg.threshold_quantile, "threshold_used"),
                                   ("population", 0.5, "population_median")])
    df = df.crossJoin(one_row(sds)).crossJoin(one_row(thr_med))
    if noise_on and cfg.population_noise_sd > 0:
        noisy = F.greatest(F.lit(0.0), F.col("population") + seeded_normal(f"pop-noise-{cfg.seed}", "cell_id")
                           * (F.lit(cfg.population_noise_sd) * F.col("_pop_sd")))
    else:
        noisy = F.col("population").cast("double")
    df = df.withColumn("population_noisy", noisy)
    if noise_on and cfg.threshold_noise_sd > 0:
        tn = F.col("threshold_used") + F.lit(threshold_noise_z(cfg.seed)) * (F.lit(cfg.threshold_noise_sd)
                                                                            * F.col("_score_sd"))
    else:
        tn = F.col("threshold_used")
    df = df.withColumn("threshold_noisy", tn)
    med_noisy = exact_quantiles(df, "population_noisy", [0.5], ["population_median_noisy"])
    df = df.crossJoin(one_row(med_noisy))
    under = (F.col("composite_score") < F.col("threshold_noisy")) & \
            (F.col("population_noisy") > F.col("population_median_noisy"))
    df = df.withColumn("label_base", (~under).cast("int"))
    if noise_on and cfg.flip_probability > 0:
        flip_key = seeded_uniform(f"flip-{cfg.seed}", "cell_id")
        n_flips = sds.select(F.floor(F.col("_n") * F.lit(cfg.flip_probability)).alias("_q"))
        keys = features.select("cell_id", flip_key.alias("_fk"))
        df = take_smallest(df.withColumn("_fk", flip_key), "_fk", n_flips, [], "cell_id", "flipped", keys).drop("_fk")
    else:
        df = df.withColumn("flipped", F.lit(False))
    df = df.withColumn("label", F.when(F.col("flipped"), 1 - F.col("label_base")).otherwise(F.col("label_base")))
    return df.withColumn("labeling_method", F.lit("supply-vs-demand")).drop("_pop_sd", "_score_sd", "_n")


def generate_labels(features: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """grid_labels with the un-noised threshold and median stored."""
    lf = label_frame(features, cfg)
    cols = ["cell_id", "composite_score", "label", "threshold_used", "labeling_method"]
    if "population" in lf.columns:
        cols += ["population", "population_median"]
    return lf.select(*cols)


def class_distribution(labels: DataFrame) -> DataFrame:
    """Count and share per label."""
    n = labels.agg(F.count(F.lit(1)).alias("_n"))
    return (labels.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
            .crossJoin(one_row(n)).withColumn("share", F.col("count") / F.col("_n")).drop("_n"))


def validate_labels(labels: DataFrame, min_minority: float = MIN_MINORITY_SHARE,
                    target_well_served: float = TARGET_WELL_SERVED_SHARE) -> DataFrame:
    """Q2: minority share >= minimum (fatal); well-served share within 5
    points of the target (warning only)."""
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("c"))
    s = counts.agg(F.min("c").alias("_min"), F.sum("c").alias("n"),
                   F.sum(F.when(F.col("label") == 1, F.col("c")).otherwise(0)).alias("_ws"))
    return s.select(
        "n", (F.col("_min") / F.col("n")).alias("minority_share"),
        (F.col("_ws") / F.col("n")).alias("well_served_share"),
        (F.col("_min") / F.col("n") >= min_minority).alias("is_valid"),
        (F.abs(F.col("_ws") / F.col("n") - target_well_served) <= 0.05).alias("well_served_ok"))


def quadrants(labels: DataFrame) -> DataFrame:
    """Supply x demand counts and percentages from the stored threshold
    and median; names follow the flags. All four quadrants are reported."""
    low = F.col("composite_score") < F.col("threshold_used")
    high = F.col("population") > F.col("population_median")
    n = labels.agg(F.count(F.lit(1)).alias("_n"))
    got = (labels.select(F.when(low, "Low").otherwise("High").alias("supply"),
                         F.when(high, "High").otherwise("Low").alias("demand"))
           .groupBy("supply", "demand").agg(F.count(F.lit(1)).alias("count")))
    spark = labels.sparkSession
    allq = spark.createDataFrame([("Low", "Low"), ("Low", "High"), ("High", "Low"), ("High", "High")],
                                 "supply string, demand string")
    out = allq.join(got, ["supply", "demand"], "left").crossJoin(one_row(n))
    return out.select("supply", "demand", F.coalesce("count", F.lit(0)).alias("count"),
                      F.round(F.coalesce("count", F.lit(0)) / F.col("_n") * 100, 1).alias("percentage"))
