"""Regular latitude/longitude grid over a bounding box."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BOUNDS, EXPECTED_AREA_KM2, EXPECTED_CELLS, KM_PER_DEGREE, METERS_PER_DEGREE


def meters_to_degrees_lat(meters: float) -> float:
    return meters / METERS_PER_DEGREE


def meters_to_degrees_lon(meters: float, latitude: float) -> float:
    return meters / (METERS_PER_DEGREE * abs(math.cos(math.radians(latitude))))


@dataclass(frozen=True)
class GridSpec:
    """Driver-side description of a grid; every cell is derived from it.

    Edges follow an arange over [min, max + step): edge i = origin + i * delta,
    where delta = (origin + step) - origin, and the count of edges is
    ceil((max + step - min) / step).
    """

    lat0: float
    lon0: float
    dlat: float
    dlon: float
    nrow: int
    ncol: int
    cell_size_m: float

    @classmethod
    def from_bounds(cls, bounds: dict | None = None, cell_size_m: float = 200) -> "GridSpec":
        b = dict(BOUNDS if bounds is None else bounds)
        step_lat = meters_to_degrees_lat(cell_size_m)
        step_lon = meters_to_degrees_lon(cell_size_m, (b["lat_min"] + b["lat_max"]) / 2)
        n_lat = math.ceil((b["lat_max"] + step_lat - b["lat_min"]) / step_lat)
        n_lon = math.ceil((b["lon_max"] + step_lon - b["lon_min"]) / step_lon)
        return cls(
            lat0=b["lat_min"], lon0=b["lon_min"],
            dlat=(b["lat_min"] + step_lat) - b["lat_min"],
            dlon=(b["lon_min"] + step_lon) - b["lon_min"],
            nrow=max(n_lat - 1, 0), ncol=max(n_lon - 1, 0), cell_size_m=cell_size_m,
        )

    @property
    def n_cells(self) -> int:
        return self.nrow * self.ncol

    @property
    def id_prefix(self) -> str:
        return f"{int(self.cell_size_m) if float(self.cell_size_m).is_integer() else self.cell_size_m}m"


def cell_id_expr(row: Column, col: Column) -> Column:
    return F.concat(F.lit("cell_"), row.cast("string"), F.lit("_"), col.cast("string"))


def census_id_expr(spec: GridSpec, row: Column, col: Column) -> Column:
    """Census-style identifier ``{size}mE{col}N{row}`` for a grid position."""
    return F.concat(F.lit(spec.id_prefix + "E"), col.cast("string"), F.lit("N"), row.cast("string"))


def generate_grid(spark: SparkSession, spec: GridSpec, with_census_id: bool = False) -> DataFrame:
    """One row per cell, row-major, generated in parallel from ``spark.range``.

    The row count is known on the driver (nrow * ncol), so no job is needed to
    size it; partitions hold about one million cells each.
    """
    n = spec.n_cells
    parts = max(1, min(n // 1_000_000 + 1, 10_000))
    ids = spark.range(0, n, 1, numPartitions=parts)
    row = (F.col("id") / F.lit(spec.ncol)).cast("long") if spec.ncol else F.lit(0).cast("long")
    col = F.col("id") % F.lit(spec.ncol) if spec.ncol else F.lit(0).cast("long")
    cells = ids.select(row.cast("int").alias("row"), col.cast("int").alias("col"))
    lat_min = F.lit(spec.lat0) + F.col("row") * F.lit(spec.dlat)
    lat_max = F.lit(spec.lat0) + (F.col("row") + 1) * F.lit(spec.dlat)
    lon_min = F.lit(spec.lon0) + F.col("col") * F.lit(spec.dlon)
    lon_max = F.lit(spec.lon0) + (F.col("col") + 1) * F.lit(spec.dlon)
    cells = cells.select(
        cell_id_expr(F.col("row"), F.col("col")).alias("cell_id"), "row", "col",
        lat_min.alias("lat_min"), lat_max.alias("lat_max"),
        lon_min.alias("lon_min"), lon_max.alias("lon_max"),
    )
    cells = cells.withColumns({
        "centroid_lat": (F.col("lat_min") + F.col("lat_max")) / 2,
        "centroid_lon": (F.col("lon_min") + F.col("lon_max")) / 2,
    })
    height = (F.col("lat_max") - F.col("lat_min")) * F.lit(KM_PER_DEGREE)
    width = ((F.col("lon_max") - F.col("lon_min")) * F.lit(KM_PER_DEGREE)
             * F.abs(F.cos(F.radians(F.col("centroid_lat")))))
    cells = cells.withColumn("area_km2", height * width)
    if with_census_id:
        cells = cells.withColumn("ID36", census_id_expr(spec, F.col("row"), F.col("col")))
    return cells


def cell_ring(prefix: str = "") -> Column:
    """Closed ring (lon, lat) of a rectangle held in bbox columns."""
    x0, x1 = F.col(prefix + "lon_min"), F.col(prefix + "lon_max")
    y0, y1 = F.col(prefix + "lat_min"), F.col(prefix + "lat_max")
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0), pt(x1, y0))


def cell_wkt() -> Column:
    return F.format_string(
        "POLYGON ((%s %s, %s %s, %s %s, %s %s, %s %s))",
        F.col("lon_max"), F.col("lat_min"), F.col("lon_max"), F.col("lat_max"),
        F.col("lon_min"), F.col("lat_max"), F.col("lon_min"), F.col("lat_min"),
        F.col("lon_max"), F.col("lat_min"))


def validate_grid(cells: DataFrame, expected_cells: int = EXPECTED_CELLS,
                  expected_area_km2: float = EXPECTED_AREA_KM2) -> DataFrame:
    """One-row quality report (Q1): count and mean area within 10%, valid
    rectangles (positive extent), no nulls in the key columns."""
    crit = ["cell_id", "lat_min", "lat_max", "lon_min", "lon_max"]
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in crit])
    agg = cells.agg(
        F.count(F.lit(1)).alias("cell_count"),
        F.avg("area_km2").alias("mean_area_km2"),
        F.min(((F.col("lat_max") > F.col("lat_min")) & (F.col("lon_max") > F.col("lon_min"))).cast("int")).alias("_valid"),
        F.max(any_null).alias("_nulls"),
    )
    return agg.select(
        "cell_count",
        F.round("mean_area_km2", 6).alias("mean_area_km2"),
        (F.abs(F.col("cell_count") - F.lit(expected_cells)) / F.lit(expected_cells) <= 0.1).alias("count_ok"),
        (F.abs(F.col("mean_area_km2") - F.lit(expected_area_km2)) / F.lit(expected_area_km2) <= 0.1).alias("area_ok"),
        (F.coalesce(F.col("_valid"), F.lit(1)) == 1).alias("geometry_ok"),
        (F.coalesce(F.col("_nulls"), F.lit(0)) == 0).alias("nulls_ok"),
    ).withColumn("is_valid", F.col("count_ok") & F.col("area_ok") & F.col("geometry_ok") & F.col("nulls_ok"))
