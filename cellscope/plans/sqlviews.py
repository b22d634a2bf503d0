"""DuckDB text of the domain views, for the SQL oracles.

Each function returns one CTE body; :func:`with_views` prefixes a query with
the CTEs it names. Doubles are written as ``CAST('<repr>' AS DOUBLE)`` so both
engines start from bit-identical constants.
"""

from __future__ import annotations

from ..config import KM_PER_DEGREE
from ..functions.seeded import sql_lit as L
from ..functions.seeded import sql_uniform as U
from ..operators.grid import GridSpec
from ..sources import fixtures as fx


def stops_sql() -> str:
    return (f"SELECT p_partkey AS stop_id, "
            f"{L(fx.BASE_LAT)} + {U('stop-lat', 'p_partkey')} * {L(fx.SPAN_LAT)} AS stop_lat, "
            f"{L(fx.BASE_LON)} + {U('stop-lon', 'p_partkey')} * {L(fx.SPAN_LON)} AS stop_lon FROM part")


def trips_sql() -> str:
    return (f"SELECT o_orderkey AS trip_id, o_custkey % {fx.N_ROUTES} AS route_id, "
            f"o_orderpriority AS service_id FROM orders")


def stop_times_sql(with_arrival: bool = False) -> str:
    extra = ""
    if with_arrival:
        key = ("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || "
               "CAST(l_partkey AS VARCHAR)")
        extra = (f", CAST({fx.ARRIVAL_START_S} + floor({U('arr', key)} * {L(fx.ARRIVAL_SPAN_S)}) AS INTEGER)"
                 f" AS arrival_s")
    return (f"SELECT l_orderkey AS trip_id, l_partkey AS stop_id, l_linenumber AS stop_sequence{extra} "
            f"FROM lineitem")


def calendar_sql() -> str:
    rows = ", ".join("(" + ", ".join([f"'{r[0]}'"] + [str(v) for v in r[1:]]) + ")" for r in fx.CALENDAR_ROWS)
    return f"SELECT * FROM (VALUES {rows}) AS t(service_id, {', '.join(fx.DAYS)})"


def cells_sql(spec: GridSpec, census_id: bool = False) -> str:
    lat_min = f"{L(spec.lat0)} + CAST(r AS DOUBLE) * {L(spec.dlat)}"
    lat_max = f"{L(spec.lat0)} + CAST(r + 1 AS DOUBLE) * {L(spec.dlat)}"
    lon_min = f"{L(spec.lon0)} + CAST(c AS DOUBLE) * {L(spec.dlon)}"
    lon_max = f"{L(spec.lon0)} + CAST(c + 1 AS DOUBLE) * {L(spec.dlon)}"
    idc = (f", '{spec.id_prefix}E' || CAST(c AS VARCHAR) || 'N' || CAST(r AS VARCHAR) AS ID36"
           if census_id else "")
    inner = (f"SELECT 'cell_' || CAST(r AS VARCHAR) || '_' || CAST(c AS VARCHAR) AS cell_id, "
             f"CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, "
             f"{lat_min} AS lat_min, {lat_max} AS lat_max, {lon_min} AS lon_min, {lon_max} AS lon_max{idc} "
             f"FROM range({spec.nrow}) AS tr(r) CROSS JOIN range({spec.ncol}) AS tc(c)")
    k = L(KM_PER_DEGREE)
    return (f"SELECT *, (lat_max - lat_min) * {k} * ((lon_max - lon_min) * {k} * "
            f"abs(cos(radians(centroid_lat)))) AS area_km2 FROM ("
            f"SELECT *, (lat_min + lat_max) / 2 AS centroid_lat, (lon_min + lon_max) / 2 AS centroid_lon "
            f"FROM ({inner}) g0) g1")


def census_sql(spec: GridSpec) -> str:
    cy = f"{L(fx.BASE_LAT)} + {U('census-lat', 'c_custkey')} * {L(fx.SPAN_LAT)}"
    cx = f"{L(fx.BASE_LON)} + {U('census-lon', 'c_custkey')} * {L(fx.SPAN_LON)}"
    pts = f"SELECT c_custkey AS census_key, {cy} AS cy, {cx} AS cx FROM customer"
    row = f"CAST(floor((cy - {L(spec.lat0)}) / {L(spec.dlat)}) AS BIGINT)"
    col = f"CAST(floor((cx - {L(spec.lon0)}) / {L(spec.dlon)}) AS BIGINT)"
    hx, hy = L(spec.dlon / 2), L(spec.dlat / 2)
    return (f"SELECT census_key, cy, cx, '{spec.id_prefix}E' || CAST({col} AS VARCHAR) || 'N' || "
            f"CAST({row} AS VARCHAR) AS ID36, "
            f"CAST(floor({U('pop', 'census_key')} * {L(fx.POP_SCALE)}) AS BIGINT) AS POP, "
            f"cx - {hx} AS xmin, cx + {hx} AS xmax, cy - {hy} AS ymin, cy + {hy} AS ymax "
            f"FROM ({pts}) p")


def with_views(spec: GridSpec, body: str, *names: str, ctes: list[str] | None = None) -> str:
    """``WITH`` clause holding the named views (then ``ctes``) followed by ``body``."""
    makers = {
        "stops": stops_sql,
        "trips": trips_sql,
        "stop_times": stop_times_sql,
        "stop_times_arr": lambda: stop_times_sql(True),
        "calendar": calendar_sql,
        "cells": lambda: cells_sql(spec),
        "cells_id": lambda: cells_sql(spec, True),
        "census": lambda: census_sql(spec),
        "customer_nulls": lambda: customer_nulls_sql(),
    }
    parts = [f"{n} AS ({makers[n]()})" for n in names] + list(ctes or [])
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def customer_nulls_sql() -> str:
    def nulled(col, tag):
        return f"CASE WHEN {U(tag, 'c_custkey')} < {L(fx.NULL_SHARE)} THEN NULL ELSE {col} END AS {col}"
    return (f"SELECT c_custkey, c_name, {nulled('c_nationkey', 'null-nation')}, "
            f"{nulled('c_acctbal', 'null-acctbal')}, {nulled('c_mktsegment', 'null-segment')} FROM customer")
