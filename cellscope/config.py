"""Run configuration as plain driver-side values.

Fixed values (must equal the published configuration for matching results):
study-area bounds lat -20.046411 .. -19.758246 and lon -44.081380 .. -43.843522;
default cell size 200 m, expected 20125 cells of 0.04 km2; metres per degree
111320; score weights stops 0.4, routes 0.3, trips 0.3; threshold quantile 0.90;
minimum minority share 0.05; target well-served share 0.10; noise on with
population sd 0.25, threshold sd 0.15, flip probability 0.05; seed 42;
test share 0.15, validation share 0.15; 5 folds; F1 gate 0.70;
population synonyms POP, TOTAL, populacao, pop_total;
id synonyms ID36, ID_UNICO, id_unico, id; population sanity maximum 3000;
the 13 model inputs; the hyper-parameter spaces of the three model families
with 20 and 15 random draws.
"""

from __future__ import annotations

from dataclasses import dataclass, field

BOUNDS = {
    "lat_min": -20.046411,
    "lat_max": -19.758246,
    "lon_min": -44.081380,
    "lon_max": -43.843522,
}
METERS_PER_DEGREE = 111320.0
KM_PER_DEGREE = 111.32
DEFAULT_CELL_SIZE_M = 200
EXPECTED_CELLS = 20125
EXPECTED_AREA_KM2 = 0.04

SCORE_WEIGHTS = {"stops": 0.4, "routes": 0.3, "trips": 0.3}
THRESHOLD_QUANTILE = 0.90
MIN_MINORITY_SHARE = 0.05
TARGET_WELL_SERVED_SHARE = 0.10
POPULATION_NOISE_SD = 0.25
THRESHOLD_NOISE_SD = 0.15
FLIP_PROBABILITY = 0.05
SEED = 42

TEST_SHARE = 0.15
VAL_SHARE = 0.15
CV_FOLDS = 5
MIN_F1 = 0.70

POP_SYNONYMS = ["POP", "TOTAL", "populacao", "pop_total"]
ID_SYNONYMS = ["ID36", "ID_UNICO", "id_unico", "id"]
MAX_REASONABLE_POP = 3000

# Feature columns excluded from model inputs, besides non-numeric columns.
MODEL_EXCLUDED = ["cell_id", "label", "composite_score", "threshold_used", "weights"]

# The model inputs, in the model's order.
MODEL_FEATURES = [
    "lat_min", "lat_max", "lon_min", "lon_max", "centroid_lat", "centroid_lon", "area_km2",
    "stop_count", "route_count", "daily_trips", "stop_density", "route_diversity", "population",
]

# Hyper-parameter spaces of the three model families.
LR_GRID = {"C": [0.01, 0.1, 1.0, 10.0], "max_iter": [1000]}
RF_SPACE = {
    "n_estimators": [100, 150, 200, 300, 500],
    "max_depth": [10, 15, 20, 25, None],
    "min_samples_split": [2, 5, 10, 15],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2"],
}
RF_N_ITER = 20
GBT_SPACE = {
    "n_estimators": [100, 150, 200, 250],
    "learning_rate": [0.01, 0.05, 0.1, 0.15],
    "max_depth": [3, 4, 5, 6, 7],
    "subsample": [0.8, 0.9, 1.0],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
}
GBT_N_ITER = 15


@dataclass(frozen=True)
class LabelConfig:
    weights: dict = field(default_factory=lambda: dict(SCORE_WEIGHTS))
    threshold_quantile: float = THRESHOLD_QUANTILE
    noise: bool = True
    population_noise_sd: float = POPULATION_NOISE_SD
    threshold_noise_sd: float = THRESHOLD_NOISE_SD
    flip_probability: float = FLIP_PROBABILITY
    seed: int = SEED
