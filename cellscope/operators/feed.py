"""Transit-feed aggregates per stop and per cell.

Plan shape at scale: ``stop_times`` (the large table) is reduced to distinct
visits (stop, trip) and joined once to ``trips``, both dealt by trip_id over
a number of tasks that follows from their rows (``session.deal``), so that a
task's memory does not grow with the tables. Only per-stop
aggregates (one row per stop) meet the stop -> cell table, and only per-cell
aggregates (one row per cell) meet the grid. The stop -> cell assignment is
arithmetic (no join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked, deal, deal_join, row_tasks
from .grid import GridSpec
from .spatial import locate_in_grid

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday"]


def weekday_services(calendar: DataFrame) -> DataFrame:
    """Services running every Monday..Friday."""
    cond = F.lit(True)
    for d in WEEKDAYS:
        cond = cond & (F.col(d) == 1)
    return calendar.filter(cond).select("service_id").distinct()


def weekday_trips(trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips of weekday services, as a semi-join (P3; never an id list).

    A service has very many trips: trips are not shuffled on it, the counted service side goes to them.
    """
    return trips.join(broadcast_checked(weekday_services(calendar)), "service_id", "left_semi")


def flag_weekday(trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """(trip_id, route_id, weekday): 1 for trips of weekday services, else 0."""
    weekday = broadcast_checked(weekday_services(calendar)).withColumn("weekday", F.lit(1))
    return trips.select("trip_id", "route_id", "service_id").join(weekday, "service_id", "left").select(
        "trip_id", "route_id", F.coalesce("weekday", F.lit(0)).alias("weekday"))


def stop_trip_routes(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """stop_times joined to trips on trip_id (J2): stop_id, trip_id, route_id, service_id."""
    st = stop_times.select("trip_id", "stop_id")
    tr = trips.select("trip_id", "route_id", "service_id")
    return st.join(tr, "trip_id")


def stop_routes(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Distinct (stop_id, route_id) pairs (J2 + A6)."""
    return stop_trip_routes(stop_times, trips).select("stop_id", "route_id").distinct()


def routes_per_stop(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Distinct routes per stop (A3)."""
    return (stop_routes(stop_times, trips).groupBy("stop_id")
            .agg(F.count(F.lit(1)).alias("route_count")))


def weekday_stop_trips(stop_times: DataFrame, trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """Distinct (stop_id, trip_id) of weekday trips."""
    tasks = row_tasks(stop_times, trips)
    st = deal(stop_times.select("trip_id", "stop_id"), tasks, "trip_id").distinct()
    return deal_join(st, weekday_trips(trips, calendar).select("trip_id"), tasks, "trip_id", "left_semi")


def trips_per_stop(stop_times: DataFrame, trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """Distinct weekday trips per stop (A4)."""
    return (weekday_stop_trips(stop_times, trips, calendar).groupBy("stop_id")
            .agg(F.count(F.lit(1)).alias("daily_trips")))


def stop_cells(stops: DataFrame, spec: GridSpec) -> DataFrame:
    """stop_id -> cell_id for stops strictly inside a cell."""
    return locate_in_grid(stops.select("stop_id", "stop_lat", "stop_lon"), spec).select("stop_id", "cell_id")


def stop_count(stops: DataFrame, spec: GridSpec) -> DataFrame:
    """Stops per non-empty cell (A1)."""
    return stop_cells(stops, spec).groupBy("cell_id").agg(F.count(F.lit(1)).alias("stop_count"))


def route_count(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, spec: GridSpec) -> DataFrame:
    """Distinct routes over the stops of a cell."""
    pairs = stop_routes(stop_times, trips).join(stop_cells(stops, spec), "stop_id")
    return (pairs.select("cell_id", "route_id").distinct().groupBy("cell_id")
            .agg(F.count(F.lit(1)).alias("route_count")))


def daily_trips(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, calendar: DataFrame,
                spec: GridSpec) -> DataFrame:
    """Sum over the cell's stops of distinct weekday trips per stop."""
    per_stop = trips_per_stop(stop_times, trips, calendar)
    sc = stop_cells(stops, spec).join(per_stop, "stop_id", "left")
    return sc.groupBy("cell_id").agg(F.sum(F.coalesce("daily_trips", F.lit(0))).cast("long").alias("daily_trips"))


def trip_cells(stops: DataFrame, stop_times: DataFrame, spec: GridSpec, tasks: int) -> DataFrame:
    """Distinct (trip_id, cell_id) of the cells in which a trip stops, dealt by trip_id."""
    pairs = deal_join(stop_times.select("trip_id", "stop_id"), stop_cells(stops, spec), tasks, "stop_id").select("trip_id", "cell_id")
    return deal(pairs, tasks, "trip_id").distinct()


def daily_trips_distinct(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, calendar: DataFrame,
                         spec: GridSpec) -> DataFrame:
    """Distinct weekday trips touching a cell."""
    tasks = row_tasks(stop_times, trips)
    pairs = deal_join(trip_cells(stops, stop_times, spec, tasks), weekday_trips(trips, calendar).select("trip_id"), tasks, "trip_id", "left_semi")
    return pairs.groupBy("cell_id").agg(F.count(F.lit(1)).alias("daily_trips_distinct"))


def complete_grid(cells: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Left-join per-cell metrics to every cell, missing -> 0."""
    out = cells
    for m in metrics:
        out = out.join(m, "cell_id", "left")
    names = [c for m in metrics for c in m.columns if c != "cell_id"]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in names})


def extract_features(cells: DataFrame, stops: DataFrame, stop_times: DataFrame, trips: DataFrame,
                     calendar: DataFrame, spec: GridSpec, include_density: bool = True) -> DataFrame:
    """Per-cell transit features (M2): stop_count, route_count, daily_trips
    and optionally stop_density (C6) and route_diversity (C7).

    stop_times and trips are read once: the distinct visits (stop, trip) are
    counted per (stop, route), then per (cell, route), which gives both the
    routes and the weekday trips of a cell. A trip has one row in ``trips``.
    """
    tasks = row_tasks(stop_times, trips)
    st = deal(stop_times.select("trip_id", "stop_id"), tasks, "trip_id").distinct()
    visits = deal_join(st, deal(flag_weekday(trips, calendar), tasks, "trip_id").distinct(), tasks, "trip_id")
    per_stop = deal(visits, tasks, "stop_id").groupBy("stop_id", "route_id").agg(F.sum("weekday").alias("_trips"))
    sc = stop_cells(stops, spec)
    per_route = deal_join(per_stop, sc, tasks, "stop_id").groupBy("cell_id", "route_id").agg(F.sum("_trips").alias("_trips"))
    served = per_route.groupBy("cell_id").agg(F.count(F.lit(1)).alias("route_count"), F.sum("_trips").alias("daily_trips"))
    counts = sc.groupBy("cell_id").agg(F.count(F.lit(1)).alias("stop_count"))
    feats = complete_grid(cells.select("cell_id", "area_km2"), counts, served)
    feats = feats.select("cell_id", "area_km2", "stop_count", "route_count", "daily_trips")
    if include_density:
        feats = feats.withColumns({
            "stop_density": F.col("stop_count") / F.col("area_km2"),
            "route_diversity": F.col("route_count"),
        })
    return feats.drop("area_km2")
