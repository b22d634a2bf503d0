"""Registered queries: key -> (spark, sf_dir) -> DataFrame, with SQL oracles.

Every query reads the driver tables (through the domain views) in full.
Doubles that go through different summation orders or math libraries are
rounded in both the Spark result and the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import feed
from ..operators.grid import validate_grid
from ..operators.ranking import one_row
from .context import QUERY_SPEC, Ctx
from .sqlviews import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SPEC = QUERY_SPEC


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Ctx(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def V(body: str, *views: str, ctes: list[str] | None = None) -> str:
    return with_views(SPEC, body, *views, ctes=ctes)


R = 9  # decimals kept for doubles computed with transcendental functions

# ---------------------------------------------------------------- grid -------


_SERVED_AREA = ("SELECT cells.* FROM cells JOIN (SELECT min(stop_lat) AS y0, max(stop_lat) AS y1, min(stop_lon) AS x0, "
                "max(stop_lon) AS x1 FROM stops) e ON lat_max >= y0 AND lat_min <= y1 AND lon_max >= x0 AND lon_min <= x1")


def served_area(c: Ctx) -> DataFrame:
    """Cells of the grid that touch the extent of the feed's stops."""
    e = c.stops.agg(F.min("stop_lat").alias("y0"), F.max("stop_lat").alias("y1"),
                    F.min("stop_lon").alias("x0"), F.max("stop_lon").alias("x1"))
    touching = "lat_max >= y0 AND lat_min <= y1 AND lon_max >= x0 AND lon_min <= x1"
    return c.cells.crossJoin(one_row(e)).where(touching).select(*c.cells.columns)


@query("grid_cells", V(f"SELECT cell_id, row, col, lat_min, lat_max, lon_min, lon_max, centroid_lat, "
                       f"centroid_lon, round(area_km2, {R}) AS area_km2 FROM ({_SERVED_AREA}) g", "stops", "cells"))
def q_grid_cells(c: Ctx) -> DataFrame:
    """Every cell of the feed's extent with bounds, centroid and area."""
    return served_area(c).withColumn("area_km2", F.round("area_km2", R))


@query("grid_quality", V(
    f"SELECT count(*) AS cell_count, round(avg(area_km2), 6) AS mean_area_km2, "
    f"abs(count(*) - 3250) / 3250.0 <= 0.1 AS count_ok, "
    f"abs(avg(area_km2) - 0.25) / 0.25 <= 0.1 AS area_ok, "
    f"min(CASE WHEN lat_max > lat_min AND lon_max > lon_min THEN 1 ELSE 0 END) = 1 AS geometry_ok, "
    f"max(CASE WHEN cell_id IS NULL OR lat_min IS NULL OR lat_max IS NULL OR lon_min IS NULL "
    f"OR lon_max IS NULL THEN 1 ELSE 0 END) = 0 AS nulls_ok, "
    f"(abs(count(*) - 3250) / 3250.0 <= 0.1) AND (abs(avg(area_km2) - 0.25) / 0.25 <= 0.1) "
    f"AND min(CASE WHEN lat_max > lat_min AND lon_max > lon_min THEN 1 ELSE 0 END) = 1 "
    f"AND max(CASE WHEN cell_id IS NULL THEN 1 ELSE 0 END) = 0 AS is_valid FROM ({_SERVED_AREA}) g", "stops", "cells"))
def q_grid_quality(c: Ctx) -> DataFrame:
    """Q1: grid validation report against the expectations of the 500 m grid that the queries use."""
    return validate_grid(served_area(c), 3250, 0.25)


# ------------------------------------------------------- point in cell -------

_IN_CELL = ("JOIN cells c ON s.stop_lat > c.lat_min AND s.stop_lat < c.lat_max "
            "AND s.stop_lon > c.lon_min AND s.stop_lon < c.lon_max")


@query("stop_cells", V(f"SELECT s.stop_id, c.cell_id FROM stops s {_IN_CELL}", "stops", "cells"))
def q_stop_cells(c: Ctx) -> DataFrame:
    """Stops strictly within a cell."""
    return feed.stop_cells(c.stops, c.spec)


@query("stop_count", V(f"SELECT c.cell_id, count(*) AS stop_count FROM stops s {_IN_CELL} GROUP BY c.cell_id",
                       "stops", "cells"))
def q_stop_count(c: Ctx) -> DataFrame:
    """A1: stops per non-empty cell."""
    return feed.stop_count(c.stops, c.spec)


@query("stop_density", V(
    f"SELECT g.cell_id, coalesce(k.n, 0) AS stop_count, round(coalesce(k.n, 0) / g.area_km2, 6) AS stop_density "
    f"FROM cells g LEFT JOIN (SELECT c.cell_id, count(*) AS n FROM stops s {_IN_CELL} GROUP BY c.cell_id) k "
    f"ON g.cell_id = k.cell_id", "stops", "cells"))
def q_stop_density(c: Ctx) -> DataFrame:
    """A1 + J5 + C6: every cell with stop count and stops per km2."""
    full = feed.complete_grid(c.cells.select("cell_id", "area_km2"), feed.stop_count(c.stops, c.spec))
    return full.select("cell_id", "stop_count",
                       F.round(F.col("stop_count") / F.col("area_km2"), 6).alias("stop_density"))


# --------------------------------------------------------- feed aggregates ---

@query("weekday_services", V("SELECT DISTINCT service_id FROM calendar WHERE monday = 1 AND tuesday = 1 "
                             "AND wednesday = 1 AND thursday = 1 AND friday = 1 AND service_id IN "
                             "(SELECT service_id FROM trips)", "calendar", "trips"))
def q_weekday_services(c: Ctx) -> DataFrame:
    """Services running Monday to Friday that the feed's trips use."""
    return feed.weekday_services(c.calendar).join(c.trips, "service_id", "left_semi")


_WD_TRIPS = ("SELECT trip_id FROM trips WHERE service_id IN (SELECT service_id FROM calendar WHERE monday = 1 "
             "AND tuesday = 1 AND wednesday = 1 AND thursday = 1 AND friday = 1)")


@query("weekday_trips", V(f"SELECT count(*) AS n_trips FROM ({_WD_TRIPS}) t", "trips", "calendar"))
def q_weekday_trips(c: Ctx) -> DataFrame:
    """Number of weekday trips (semi-join)."""
    return feed.weekday_trips(c.trips, c.calendar).agg(F.count(F.lit(1)).alias("n_trips"))


@query("routes_per_stop", V("SELECT st.stop_id, count(DISTINCT t.route_id) AS route_count FROM stop_times st "
                            "JOIN trips t ON st.trip_id = t.trip_id GROUP BY st.stop_id", "stop_times", "trips"))
def q_routes_per_stop(c: Ctx) -> DataFrame:
    """J2 + A3: distinct routes per stop."""
    return feed.routes_per_stop(c.stop_times, c.trips)


@query("trips_per_stop", V(f"SELECT stop_id, count(DISTINCT trip_id) AS daily_trips FROM stop_times "
                           f"WHERE trip_id IN ({_WD_TRIPS}) GROUP BY stop_id", "stop_times", "trips", "calendar"))
def q_trips_per_stop(c: Ctx) -> DataFrame:
    """P3 + A4: distinct weekday trips per stop."""
    return feed.trips_per_stop(c.stop_times, c.trips, c.calendar)


@query("route_count", V(
    f"SELECT c.cell_id, count(DISTINCT t.route_id) AS route_count FROM stops s {_IN_CELL} "
    f"JOIN stop_times st ON st.stop_id = s.stop_id JOIN trips t ON t.trip_id = st.trip_id GROUP BY c.cell_id",
    "stops", "cells", "stop_times", "trips"))
def q_route_count(c: Ctx) -> DataFrame:
    """A2 + J3: distinct routes per non-empty cell."""
    return feed.route_count(c.stops, c.stop_times, c.trips, c.spec)


@query("daily_trips", V(
    f"SELECT c.cell_id, CAST(sum(coalesce(p.n, 0)) AS BIGINT) AS daily_trips FROM stops s {_IN_CELL} "
    f"LEFT JOIN (SELECT stop_id, count(DISTINCT trip_id) AS n FROM stop_times WHERE trip_id IN ({_WD_TRIPS}) "
    f"GROUP BY stop_id) p ON p.stop_id = s.stop_id GROUP BY c.cell_id", "stops", "cells", "stop_times", "trips",
    "calendar"))
def q_daily_trips(c: Ctx) -> DataFrame:
    """A5 + J4: sum over a cell's stops of distinct weekday trips."""
    return feed.daily_trips(c.stops, c.stop_times, c.trips, c.calendar, c.spec)


@query("daily_trips_distinct", V(
    f"SELECT c.cell_id, count(DISTINCT st.trip_id) AS daily_trips_distinct FROM stops s {_IN_CELL} "
    f"JOIN stop_times st ON st.stop_id = s.stop_id WHERE st.trip_id IN ({_WD_TRIPS}) GROUP BY c.cell_id",
    "stops", "cells", "stop_times", "trips", "calendar"))
def q_daily_trips_distinct(c: Ctx) -> DataFrame:
    """Distinct weekday trips touching a cell."""
    return feed.daily_trips_distinct(c.stops, c.stop_times, c.trips, c.calendar, c.spec)


FEATURES_SQL = (
    f"SELECT g.cell_id, coalesce(a.stop_count, 0) AS stop_count, coalesce(r.route_count, 0) AS route_count, "
    f"coalesce(a.daily_trips, 0) AS daily_trips, coalesce(a.stop_count, 0) / g.area_km2 AS stop_density, "
    f"coalesce(r.route_count, 0) AS route_diversity FROM cells g "
    f"LEFT JOIN (SELECT c.cell_id, count(*) AS stop_count, CAST(sum(coalesce(p.n, 0)) AS BIGINT) AS daily_trips "
    f"FROM stops s {_IN_CELL} LEFT JOIN (SELECT stop_id, count(DISTINCT trip_id) AS n FROM stop_times "
    f"WHERE trip_id IN ({_WD_TRIPS}) GROUP BY stop_id) p ON p.stop_id = s.stop_id GROUP BY c.cell_id) a "
    f"ON a.cell_id = g.cell_id "
    f"LEFT JOIN (SELECT c.cell_id, count(DISTINCT t.route_id) AS route_count FROM stops s {_IN_CELL} "
    f"JOIN stop_times st ON st.stop_id = s.stop_id JOIN trips t ON t.trip_id = st.trip_id GROUP BY c.cell_id) r "
    f"ON r.cell_id = g.cell_id")
FEATURE_VIEWS = ("stops", "cells", "stop_times", "trips", "calendar")


@query("grid_features", V(
    f"SELECT cell_id, stop_count, route_count, daily_trips, round(stop_density, 6) AS stop_density, "
    f"route_diversity FROM ({FEATURES_SQL}) f", *FEATURE_VIEWS))
def q_grid_features(c: Ctx) -> DataFrame:
    """M2: per-cell feature table over the whole grid."""
    return c.features.withColumn("stop_density", F.round("stop_density", 6))
