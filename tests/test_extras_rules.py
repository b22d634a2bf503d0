"""Headway deviation, best threshold rules and paired comparison against plain Python."""

import math
import random
import statistics

from cellscope.operators import extras, metrics


def test_headways(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(40), rng.randrange(3), 18000 + rng.randrange(200) * 300) for _ in range(600)] + [(1, 9, 5), (2, 8, 7), (2, 8, 7), (3, 8, None)]
    st = spark.createDataFrame(rows, "trip_id int, stop_id int, arrival_s int")
    trips = spark.createDataFrame([(t, t % 4) for t in range(40)], "trip_id int, route_id int")
    groups = {}
    for t, s, a in rows:
        if a is not None:
            groups.setdefault((s, t % 4), []).append(a)
    got = {(r["stop_id"], r["route_id"]): r for r in extras.headway_variability(st, trips, 1000).collect()}
    assert set(got) == {k for k, v in groups.items() if len(v) > 1}
    for k, r in got.items():
        v = sorted(groups[k])
        gaps = [b - a for a, b in zip(v, v[1:])]
        assert r["n"] == len(v) and math.isclose(r["mean_headway_s"], statistics.mean(gaps), abs_tol=1e-9)
        assert r["headway_std_s"] is None if len(gaps) == 1 else math.isclose(r["headway_std_s"], statistics.stdev(gaps), rel_tol=1e-9, abs_tol=1e-6)


def test_best_threshold(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(12), rng.random(), rng.randrange(2)) for _ in range(150)] + [(None, 0.5, 1), (3, 0.5, None)]
    got = {r["feature"]: r for r in metrics.best_threshold(spark.createDataFrame(rows, "a int, b double, label int"), ["a", "b"]).collect()}
    for i, name in enumerate(("a", "b")):
        seen = [(r[i], r[2]) for r in rows if r[i] is not None and r[2] is not None]
        tried = [(sum((v >= t) == (y == 1) if d == ">=" else (v < t) == (y == 1) for v, y in seen), d == ">=", -t) for t in {v for v, _ in seen} for d in (">=", "<")]
        hits, at_least, minus = max(tried)
        assert (got[name]["direction"], got[name]["threshold"]) == (">=" if at_least else "<", float(-minus))
        assert math.isclose(got[name]["accuracy"], hits / len(seen))


def test_paired_comparison(spark):
    rows = [(1, 0.9, 0.2)] * 5 + [(0, 0.9, 0.2)] * 12 + [(1, 0.8, 0.8)] * 20 + [(0, 0.1, 0.3)] * 9
    got = {r["feature_set"]: r for r in metrics.compare_feature_sets(spark.createDataFrame(rows, "label int, x double, y double"), {"one": ("x", ["f"]), "two": ("y", ["f", "g"])}).collect()}
    assert (got["one"]["only_this"], got["two"]["only_this"], got["one"]["rows"]) == (5, 12, 46)
    assert math.isclose(got["one"]["chi2"], 36 / 17) and got["two"]["n_features"] == 2
