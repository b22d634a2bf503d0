"""Planar geometry on ring columns ``array<struct<x:double,y:double>>``.

All functions build Column expressions (higher-order functions over the ring
array), so they run inside the JVM next to the scan; no Python per row.
Rings are closed (first point == last point); x is longitude, y latitude.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RING_TYPE = "array<struct<x:double,y:double>>"


def _bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once: an expression named many times in ``f`` would be evaluated at each place."""
    return F.get(F.transform(F.array(value), f), 0)


def _edges(ring: Column) -> Column:
    """Indices 0 .. n-2 of the edges (i, i+1) of a closed ring."""
    return F.sequence(F.lit(0), F.size(ring) - 2)


def point_in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Strict interior test (C18): even-odd ray casting; a point on an edge
    or vertex is outside, as for ``within``."""
    def crosses(i):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        ay, by, ax, bx = a["y"], b["y"], a["x"], b["x"]
        straddles = (ay > py) != (by > py)
        x_at = (bx - ax) * (py - ay) / (by - ay) + ax
        return straddles & (px < x_at)

    def on_edge(i):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        inside_box = (px >= F.least(ax, bx)) & (px <= F.greatest(ax, bx)) & \
                     (py >= F.least(ay, by)) & (py <= F.greatest(ay, by))
        return (cross == 0) & inside_box

    n_cross = F.aggregate(_edges(ring), F.lit(0), lambda acc, i: acc + F.when(crosses(i), 1).otherwise(0))
    return F.when(F.size(ring) < 4, F.lit(False)).otherwise(
        ((n_cross % 2) == 1) & ~F.exists(_edges(ring), on_edge))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area."""
    return F.aggregate(
        _edges(ring), F.lit(0.0),
        lambda acc, i: acc + (F.get(ring, i)["x"] * F.get(ring, i + 1)["y"]
                              - F.get(ring, i + 1)["x"] * F.get(ring, i)["y"])) / 2


def ring_centroid(ring: Column) -> Column:
    """Area centroid as struct(x, y) (C17)."""
    def term(i, coord):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        w = a["x"] * b["y"] - b["x"] * a["y"]
        return (a[coord] + b[coord]) * w

    sx = F.aggregate(_edges(ring), F.lit(0.0), lambda acc, i: acc + term(i, "x"))
    sy = F.aggregate(_edges(ring), F.lit(0.0), lambda acc, i: acc + term(i, "y"))
    a6 = ring_area(ring) * 6
    return F.struct((sx / a6).alias("x"), (sy / a6).alias("y"))


def ring_bbox(ring: Column) -> dict:
    xs = F.transform(ring, lambda p: p["x"])
    ys = F.transform(ring, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs),
            "ymin": F.array_min(ys), "ymax": F.array_max(ys)}


def ring_is_closed(ring: Column) -> Column:
    return (F.size(ring) > 0) & (F.get(ring, 0) == F.get(ring, F.size(ring) - 1))


def ring_self_intersects(ring: Column) -> Column:
    """True when two non-adjacent edges cross (proper crossing)."""
    def orient(p, q, r):
        return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    n_edges = F.size(ring) - 1

    def pair(i, j):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        c, d = F.get(ring, j), F.get(ring, j + 1)
        adjacent = (j == i + 1) | ((i == 0) & (j == n_edges - 1))
        return (~adjacent) & (orient(a, b, c) * orient(a, b, d) < 0) & (orient(c, d, a) * orient(c, d, b) < 0)

    return F.exists(_edges(ring), lambda i: F.exists(_edges(ring), lambda j: (j > i) & pair(i, j)))


def ring_is_valid(ring: Column) -> Column:
    """Closed, at least 4 points, non-zero area, no crossing edges."""
    return _bound(ring, lambda r: (r.isNotNull() & (F.size(r) >= 4) & ring_is_closed(r)
                                   & (ring_area(r) != 0) & ~ring_self_intersects(r)))


def repair_ring(ring: Column) -> Column:
    """The simple repairs: drop consecutive repeated points, then close."""
    dedup = _bound(ring, lambda r: F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, i - 1))))
    return _bound(dedup, lambda d: F.when(ring_is_closed(d), d).otherwise(F.concat(d, F.array(F.get(d, 0)))))


def rect_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(pt(xmax, ymin), pt(xmax, ymax), pt(xmin, ymax), pt(xmin, ymin), pt(xmax, ymin))


# --- Transverse Mercator (UTM) by the Krueger series, GRS80 / WGS84 -------------
# a = 6378137 m, 1/f = 298.257222101 (GRS80), k0 = 0.9996,
# false easting 500000 m, false northing 10000000 m in the south.
_A = 6378137.0
_F = 1 / 298.257222101
_N = _F / (2 - _F)
_AA = _A / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_ALPHA = [_N / 2 - 2 * _N ** 2 / 3 + 5 * _N ** 3 / 16, 13 * _N ** 2 / 48 - 3 * _N ** 3 / 5, 61 * _N ** 3 / 240]
_BETA = [_N / 2 - 2 * _N ** 2 / 3 + 37 * _N ** 3 / 96, _N ** 2 / 48 + _N ** 3 / 15, 17 * _N ** 3 / 480]
_DELTA = [2 * _N - 2 * _N ** 2 / 3 - 2 * _N ** 3, 7 * _N ** 2 / 3 - 8 * _N ** 3 / 5, 56 * _N ** 3 / 15]
_K0 = 0.9996
_E0 = 500000.0

# Supported codes: geographic (treated as identical at city scale) and UTM 23S.
GEOGRAPHIC = {"EPSG:4326", "EPSG:4674"}
UTM = {"EPSG:31983": (-45.0, 10000000.0)}


def lonlat_to_utm(lon: Column, lat: Column, crs: str = "EPSG:31983") -> Column:
    lon0, n0 = UTM[crs]
    phi = F.radians(lat)
    lam = F.radians(lon) - F.lit(math.radians(lon0))
    c = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(c) * F.atanh(F.lit(c) * F.sin(phi)))
    xi = F.atan(t / F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e = eta
    nn = xi
    for j, a in enumerate(_ALPHA, start=1):
        e = e + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        nn = nn + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((F.lit(_E0) + F.lit(_K0 * _AA) * e).alias("x"),
                    (F.lit(n0) + F.lit(_K0 * _AA) * nn).alias("y"))


def utm_to_lonlat(x: Column, y: Column, crs: str = "EPSG:31983") -> Column:
    lon0, n0 = UTM[crs]
    xi = (y - F.lit(n0)) / F.lit(_K0 * _AA)
    eta = (x - F.lit(_E0)) / F.lit(_K0 * _AA)
    xp, ep = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xp = xp - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        ep = ep - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xp) / F.cosh(ep))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    lam = F.lit(math.radians(lon0)) + F.atan(F.sinh(ep) / F.cos(xp))
    return F.struct(F.degrees(lam).alias("x"), F.degrees(phi).alias("y"))


def transform_ring(ring: Column, src: str, dst: str) -> Column:
    """Reproject every vertex (C20). Geographic codes are interchangeable."""
    if src == dst or (src in GEOGRAPHIC and dst in GEOGRAPHIC):
        return ring
    if src in GEOGRAPHIC and dst in UTM:
        return F.transform(ring, lambda p: lonlat_to_utm(p["x"], p["y"], dst))
    if src in UTM and dst in GEOGRAPHIC:
        return F.transform(ring, lambda p: utm_to_lonlat(p["x"], p["y"], src))
    raise ValueError(f"unsupported CRS pair {src} -> {dst}")
