"""Nearest-neighbour mutual information against every row compared with every row."""

import math
import random

from pyspark.sql import functions as F

from cellscope.operators import ranking, selection


def _digamma(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def _brute(points, k):
    sizes = {}
    for _, y in points:
        sizes[y] = sizes.get(y, 0) + 1
    points = [(x, y) for x, y in points if sizes[y] > 1]
    total = [0.0, 0.0, 0.0]
    for i, (x, y) in enumerate(points):
        kk = min(k, sizes[y] - 1)
        r = sorted(abs(b - x) for j, (b, z) in enumerate(points) if j != i and z == y)[kk - 1]
        m = sum((x - r < b < x + r) or b == x for b, _ in points)
        total = [t + _digamma(v) for t, v in zip(total, (kk, sizes[y], m))]
    n = len(points)
    return max(0.0, _digamma(n) + (total[0] - total[1] - total[2]) / n)


def test_mutual_info_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        y = rng.choice([0, 0, 0, 1, 2])
        rows.append((i, rng.gauss(3 * y, 1), float(rng.randrange(6) + y), rng.random(), y))
    rows += [(300, 1.0, 1.0, None, 7), (301, 2.0, 2.0, 0.5, None), (302, None, 3.0, 0.1, 1)]
    df = spark.createDataFrame(rows, "cell_id int, a double, b double, c double, label int")
    monkeypatch.setattr(selection, "BLOCK_ROWS", 7)  # blocks and parts far smaller than a class
    monkeypatch.setattr(ranking, "PART_ROWS", 90)
    got = {r["feature"]: r["mutual_info"] for r in selection.mutual_info(df, ["a", "b", "c"]).collect()}
    for i, name in ((1, "a"), (2, "b"), (3, "c")):
        want = _brute([(r[i], r[4]) for r in rows if r[i] is not None and r[4] is not None], 3)
        assert math.isclose(got[name], want, abs_tol=1e-9), name
    assert got["a"] > max(got["b"], got["c"])
    assert [r["feature"] for r in selection.select_k_best(df, ["a", "b", "c"], 1, method="mutual_info").collect()] == ["a"]


def test_positions(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PART_ROWS", 50)
    df = spark.range(400).select((F.col("id") % 3).alias("g"), F.col("id"), (F.col("id") % 5).alias("v"))
    rows = sorted(map(tuple, ranking.positions(df, ["g", "id"], "t", {"total": "v"}).collect()))
    running = 0
    for i, (g, _, v, pos, total) in enumerate(rows):
        running += v
        assert (pos, total) == (i, running)
