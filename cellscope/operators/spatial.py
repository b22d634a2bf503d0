"""Spatial joins as equi-joins on bin keys.

A plain range predicate between two tables plans as a nested-loop join; here
both sides get integer bin coordinates, the join is a hash/sort-merge
equi-join on them, and the exact predicate runs as a residual filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import point_in_ring, ring_bbox
from .grid import GridSpec, cell_id_expr
from .ranking import one_row


def _axis_candidate(v: Column, origin: float, step: float) -> Column:
    return F.floor((v - F.lit(origin)) / F.lit(step))


def _axis_corrected(v: Column, i0: Column, origin: float, step: float) -> Column:
    """Floor division may land one bin off when v is within rounding of an
    edge, so the candidate is corrected against the edges exactly as the grid
    computes them (origin + i * step)."""
    o, s = F.lit(origin), F.lit(step)
    return F.when(v < o + i0 * s, i0 - 1).when(v >= o + (i0 + 1) * s, i0 + 1).otherwise(i0)


def _axis_inside(v: Column, i: Column, origin: float, step: float, n: int) -> Column:
    """Strict ``within``: a value equal to an edge lies in no cell."""
    o, s = F.lit(origin), F.lit(step)
    return (v > o + i * s) & (v < o + (i + 1) * s) & (i >= 0) & (i < n)


def locate_in_grid(df: DataFrame, spec: GridSpec, lat: str = "stop_lat", lon: str = "stop_lon",
                   keep_outside: bool = False) -> DataFrame:
    """Point-in-cell join against a regular grid without any join (J1 fast path).

    The cell of a point is computed from its coordinates, so the operator is a
    narrow projection + filter: no shuffle, no broadcast, no skew. Points on a
    cell edge or outside the grid are dropped (inner ``within``) unless
    ``keep_outside`` (then ``cell_id`` is null). The steps are separate
    projections so the optimizer keeps each bin index computed once.
    """
    out = df.withColumns({"_r0": _axis_candidate(F.col(lat), spec.lat0, spec.dlat),
                          "_c0": _axis_candidate(F.col(lon), spec.lon0, spec.dlon)})
    out = out.withColumns({"_r1": _axis_corrected(F.col(lat), F.col("_r0"), spec.lat0, spec.dlat),
                           "_c1": _axis_corrected(F.col(lon), F.col("_c0"), spec.lon0, spec.dlon)})
    inside = (_axis_inside(F.col(lat), F.col("_r1"), spec.lat0, spec.dlat, spec.nrow)
              & _axis_inside(F.col(lon), F.col("_c1"), spec.lon0, spec.dlon, spec.ncol))
    hit = F.struct(F.col("_r1").cast("int").alias("row"), F.col("_c1").cast("int").alias("col"))
    # A 0/1-element array + explode gives inner-join semantics; unlike a
    # Filter it is not pushed below the projections (which would inline and
    # re-evaluate the coordinate expressions once per reference).
    pos = F.when(inside, F.array(hit)).otherwise(F.array().cast("array<struct<row:int,col:int>>"))
    keep = [c for c in df.columns if c not in ("row", "col", "cell_id")]
    if keep_outside:
        out = out.select(*keep, F.explode_outer(pos).alias("_hit"))
    else:
        out = out.select(*keep, F.explode(pos).alias("_hit"))
    out = out.select(*keep, F.col("_hit.row").alias("row"), F.col("_hit.col").alias("col"))
    return out.withColumn("cell_id", F.when(F.col("row").isNotNull(), cell_id_expr(F.col("row"), F.col("col"))))


def _bin(v: Column, size: Column) -> Column:
    return F.floor(v / size).cast("long")


def points_in_rects(points: DataFrame, rects: DataFrame, bin_size: float,
                    px: str = "x", py: str = "y",
                    xmin: str = "xmin", xmax: str = "xmax", ymin: str = "ymin", ymax: str = "ymax",
                    residual=None) -> DataFrame:
    """General point-in-rectangle BIN-JOIN for tables that are not a regular grid.

    Each rectangle is replicated to the bins its bbox overlaps
    (``explode(sequence)``), and the join is an equi-join on (level, bx, by)
    plus the strict bbox test (or ``residual(points, rects)`` when given).
    A rectangle wider than two bins takes bins of twice, four times, ... the
    size, so that it has at most nine copies whatever its extent; a point gets
    one bin for every size in use (one row of sizes, one for a table of
    rectangles of like extent).
    """
    extent = F.greatest(F.col(xmax) - F.col(xmin), F.col(ymax) - F.col(ymin))
    level = F.greatest(F.coalesce(F.ceil(F.log2(extent / (2 * bin_size))), F.lit(0)), F.lit(0)).cast("int")
    r = rects.withColumn("_level", level)
    levels = r.agg(F.collect_set("_level").alias("_levels"))
    size = F.lit(bin_size) * F.pow(F.lit(2.0), F.col("_level"))
    r = r.withColumn("_bx", F.explode(F.sequence(_bin(F.col(xmin), size), _bin(F.col(xmax), size))))
    r = r.withColumn("_by", F.explode(F.sequence(_bin(F.col(ymin), size), _bin(F.col(ymax), size))))
    p = points.crossJoin(one_row(levels)).select(*points.columns, F.explode("_levels").alias("_level"))
    p = p.withColumns({"_bx": _bin(F.col(px), size), "_by": _bin(F.col(py), size)})
    keys = ["_level", "_bx", "_by"]
    cond = [p[k] == r[k] for k in keys]
    if residual is None:
        cond += [p[px] > r[xmin], p[px] < r[xmax], p[py] > r[ymin], p[py] < r[ymax]]
    else:
        cond.append(residual(p, r))
    return p.join(r, cond).drop(*keys)


def points_in_polygons(points: DataFrame, polys: DataFrame, bin_size: float,
                       px: str = "x", py: str = "y", ring: str = "ring") -> DataFrame:
    """Point-within-polygon BIN-JOIN (J8): polygon bbox bins, then ray casting."""
    bb = ring_bbox(F.col(ring))
    polys = polys.withColumns({"_xmin": bb["xmin"], "_xmax": bb["xmax"],
                               "_ymin": bb["ymin"], "_ymax": bb["ymax"]})

    def residual(p, r):
        return ((p[px] > r["_xmin"]) & (p[px] < r["_xmax"]) & (p[py] > r["_ymin"]) & (p[py] < r["_ymax"])
                & point_in_ring(p[px], p[py], r[ring]))

    out = points_in_rects(points, polys, bin_size, px, py, "_xmin", "_xmax", "_ymin", "_ymax",
                          residual=residual)
    return out.drop("_xmin", "_xmax", "_ymin", "_ymax")
