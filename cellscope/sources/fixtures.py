"""Domain tables (stops, trips, stop_times, calendar, census) as Spark views
over the driver's Parquet tables.

Mapping (same text in ``plans/sqlviews.py`` for the SQL oracles):
  part     -> stops       stop_id = p_partkey, coordinates from seeded uniforms
                          spread over the study bounds plus a 0.005 degree margin
  orders   -> trips       trip_id = o_orderkey, route_id = o_custkey % 320,
                          service_id = o_orderpriority
  lineitem -> stop_times  trip_id = l_orderkey, stop_id = l_partkey,
                          stop_sequence = l_linenumber, arrival_s in 05:00-24:00
  customer -> census      one census square of one cell per customer, placed
                          by seeded uniforms; POP seeded in [0, 2000)
Every view is a projection of a scan, so the work grows with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BOUNDS
from ..functions.seeded import seeded_uniform
from ..operators.grid import GridSpec, census_id_expr

N_ROUTES = 320
MARGIN_DEG = 0.005
BASE_LAT = BOUNDS["lat_min"] - MARGIN_DEG
SPAN_LAT = (BOUNDS["lat_max"] - BOUNDS["lat_min"]) + 2 * MARGIN_DEG
BASE_LON = BOUNDS["lon_min"] - MARGIN_DEG
SPAN_LON = (BOUNDS["lon_max"] - BOUNDS["lon_min"]) + 2 * MARGIN_DEG
ARRIVAL_START_S = 18000
ARRIVAL_SPAN_S = 68400
POP_SCALE = 2000

# The service calendar of the five order priorities
# (monday .. sunday flags).
CALENDAR_ROWS = [
    ("1-URGENT", 1, 1, 1, 1, 1, 0, 0),
    ("2-HIGH", 1, 1, 1, 1, 1, 0, 0),
    ("3-MEDIUM", 1, 1, 0, 1, 1, 1, 1),
    ("4-NOT SPECIFIED", 0, 0, 0, 0, 0, 1, 0),
    ("5-LOW", 0, 0, 0, 0, 0, 0, 1),
]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    if not os.path.exists(path) and "://" not in path:
        raise FileNotFoundError(f"table '{name}' not found at {path}")
    return spark.read.parquet(path)


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey")
    return p.select(
        F.col("p_partkey").alias("stop_id"),
        (F.lit(BASE_LAT) + seeded_uniform("stop-lat", "p_partkey") * F.lit(SPAN_LAT)).alias("stop_lat"),
        (F.lit(BASE_LON) + seeded_uniform("stop-lon", "p_partkey") * F.lit(SPAN_LON)).alias("stop_lon"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("trip_id"),
        (F.col("o_custkey") % N_ROUTES).alias("route_id"),
        F.col("o_orderpriority").alias("service_id"),
    )


def stop_times(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cols = [F.col("l_orderkey").alias("trip_id"), F.col("l_partkey").alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence")]
    if with_arrival:
        key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                          F.col("l_partkey").cast("string"))
        cols.append((F.lit(ARRIVAL_START_S)
                     + F.floor(seeded_uniform("arr", key) * F.lit(ARRIVAL_SPAN_S))).cast("int").alias("arrival_s"))
    return li.select(*cols)


def calendar(spark: SparkSession) -> DataFrame:
    schema = "service_id string, " + ", ".join(f"{d} int" for d in DAYS)
    return spark.createDataFrame(CALENDAR_ROWS, schema)


def census_points(spark: SparkSession, sf_dir: str, spec: GridSpec) -> DataFrame:
    """Census squares: centre, census id of the grid position, POP."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    cy = F.lit(BASE_LAT) + seeded_uniform("census-lat", "c_custkey") * F.lit(SPAN_LAT)
    cx = F.lit(BASE_LON) + seeded_uniform("census-lon", "c_custkey") * F.lit(SPAN_LON)
    out = c.select(F.col("c_custkey").alias("census_key"), cy.alias("cy"), cx.alias("cx"))
    row = F.floor((F.col("cy") - F.lit(spec.lat0)) / F.lit(spec.dlat))
    col = F.floor((F.col("cx") - F.lit(spec.lon0)) / F.lit(spec.dlon))
    return out.select(
        "census_key", "cy", "cx",
        census_id_expr(spec, row, col).alias("ID36"),
        F.floor(seeded_uniform("pop", "census_key") * F.lit(POP_SCALE)).cast("long").alias("POP"),
    )


def census(spark: SparkSession, sf_dir: str, spec: GridSpec) -> DataFrame:
    """Census table with ring geometry: ID36, POP, ring (one cell wide)."""
    from ..functions.geo import rect_ring

    pts = census_points(spark, sf_dir, spec)
    hx, hy = F.lit(spec.dlon / 2), F.lit(spec.dlat / 2)
    ring = rect_ring(F.col("cx") - hx, F.col("cy") - hy, F.col("cx") + hx, F.col("cy") + hy)
    return pts.select("ID36", "POP", ring.alias("ring"))


NULL_SHARE = 0.05


def customer_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tabular case: ``customer`` with about 5% nulls injected per column by
    seeded keys (nation, balance, segment)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")

    def nulled(col, tag):
        return F.when(seeded_uniform(tag, "c_custkey") < NULL_SHARE, F.lit(None)).otherwise(F.col(col)).alias(col)

    return c.select("c_custkey", "c_name", nulled("c_nationkey", "null-nation"),
                    nulled("c_acctbal", "null-acctbal"), nulled("c_mktsegment", "null-segment"))


def new_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What-if input: one proposed stop per supplier, placed by seeded
    uniforms over the same area (ids offset to stay apart from part keys)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    return s.select(
        (F.col("s_suppkey") + F.lit(10 ** 12)).alias("stop_id"),
        (F.lit(BASE_LAT) + seeded_uniform("new-stop-lat", "s_suppkey") * F.lit(SPAN_LAT)).alias("stop_lat"),
        (F.lit(BASE_LON) + seeded_uniform("new-stop-lon", "s_suppkey") * F.lit(SPAN_LON)).alias("stop_lon"))
