"""End-to-end batch pipeline (stages 1-7 of the reference workflow, M11).

grid -> features (+ z-scores) -> census merge (+ population z-score) ->
validation -> labels -> stratified splits -> model search -> test metrics.
Stage outputs that later stages read several times are written once as
Parquet under ``out_dir`` (a shared folder on a cluster) and read back, the
same boundaries the reference keeps between its processes.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import MODEL_FEATURES
from ..operators import census as cs
from ..operators import feed, ml, split
from ..operators.grid import GridSpec, generate_grid, validate_grid
from ..operators.labels import generate_labels, validate_labels
from ..operators.scaling import normalize_features, normalize_population
from ..sources import fixtures as fx
from ..sources.io import save_csv, save_table

MODEL_INPUTS = MODEL_FEATURES


def run_pipeline(spark: SparkSession, sf_dir: str, out_dir: str, cell_size_m: float = 200,
                 models: list[str] | None = None, search: dict | None = None) -> dict:
    """Run every stage; returns per-stage seconds and the main one-row reports."""
    t, times = time.time(), {}

    def lap(name):
        nonlocal t
        times[name] = round(time.time() - t, 3)
        t = time.time()

    spec = GridSpec.from_bounds(cell_size_m=cell_size_m)
    cells = generate_grid(spark, spec, with_census_id=True)
    save_table(cells, os.path.join(out_dir, "cells.parquet"))
    cells = spark.read.parquet(os.path.join(out_dir, "cells.parquet"))
    grid_report = validate_grid(cells).first().asDict()
    lap("grid")

    stops, trips = fx.stops(spark, sf_dir), fx.trips(spark, sf_dir)
    st, cal = fx.stop_times(spark, sf_dir), fx.calendar(spark)
    feats = normalize_features(feed.extract_features(cells, stops, st, trips, cal, spec))
    save_table(feats, os.path.join(out_dir, "grid_features.parquet"))
    feats = spark.read.parquet(os.path.join(out_dir, "grid_features.parquet"))
    lap("features")

    census = cs.load_census(fx.census(spark, sf_dir, spec))
    merged = cs.merge_population(cells.select("cell_id", "ID36"), census, "auto", bin_size=spec.dlon)
    enriched = normalize_population(feats.join(merged.select("cell_id", "population"), "cell_id", "left")
                                    .withColumn("population", F.coalesce("population", F.lit(0)).cast("long")))
    save_table(enriched, os.path.join(out_dir, "grid_features_pop.parquet"))
    enriched = spark.read.parquet(os.path.join(out_dir, "grid_features_pop.parquet"))
    pop_report = cs.validate_population(enriched, min_coverage_pct=50.0, max_zero_pop_pct=50.0).first().asDict()
    lap("census")

    labels = generate_labels(enriched)
    save_table(labels, os.path.join(out_dir, "grid_labels.parquet"))
    labels = spark.read.parquet(os.path.join(out_dir, "grid_labels.parquet"))
    label_report = validate_labels(labels).first().asDict()
    lap("labels")

    data = split.merge_features_labels(cells.select("cell_id", *MODEL_INPUTS[:7]).join(enriched, "cell_id"), labels)
    splits = split.stratified_split(data)
    save_table(splits, os.path.join(out_dir, "splits.parquet"), partition_by=["split"])
    splits = spark.read.parquet(os.path.join(out_dir, "splits.parquet"))
    split_report = split.validate_splits(splits, data).first().asDict()
    lap("splits")

    out = {"times": times, "grid": grid_report, "population": pop_report, "labels": label_report,
           "splits": split_report}
    if models:
        tr, va, te = (splits.filter(F.col("split") == s) for s in ("train", "val", "test"))
        res, fitted = ml.train_all(tr, va, MODEL_INPUTS, models=models, **(search or {}))
        save_csv(res, os.path.join(out_dir, "search_results.csv"))
        lap("training")
        best = ml.select_best(res).first()["model"]
        rep = ml.evaluate(fitted[best], te, best)
        save_csv(rep, os.path.join(out_dir, "test_metrics.csv"))
        out["test"] = rep.first().asDict()
        ml.save_model(fitted[best], os.path.join(out_dir, "best_model"))
        lap("evaluation")
    return out
