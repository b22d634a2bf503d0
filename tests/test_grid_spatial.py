from pyspark.sql import functions as F

from cellscope.functions.geo import point_in_ring, rect_ring, ring_centroid, ring_is_valid, lonlat_to_utm, utm_to_lonlat
from cellscope.operators.grid import GridSpec, generate_grid, validate_grid
from cellscope.operators.spatial import locate_in_grid, points_in_polygons, points_in_rects


def test_grid_golden_sizes():
    s200 = GridSpec.from_bounds(cell_size_m=200)
    assert (s200.nrow, s200.ncol, s200.n_cells) == (161, 125, 20125)
    s500 = GridSpec.from_bounds(cell_size_m=500)
    assert (s500.nrow, s500.ncol, s500.n_cells) == (65, 50, 3250)


def test_grid_rows_and_quality(spark):
    spec = GridSpec.from_bounds(cell_size_m=200)
    cells = generate_grid(spark, spec)
    q = validate_grid(cells).first()
    assert q["cell_count"] == 20125 and q["is_valid"]
    assert cells.select("cell_id").distinct().count() == 20125
    first = cells.filter("cell_id = 'cell_0_0'").first()
    assert first["lat_min"] == spec.lat0 and first["lon_min"] == spec.lon0


def test_point_on_edge_is_in_no_cell(spark):
    spec = GridSpec.from_bounds(cell_size_m=500)
    edge_lat = spec.lat0 + 3 * spec.dlat
    inside_lat = spec.lat0 + 3.5 * spec.dlat
    lon = spec.lon0 + 2.5 * spec.dlon
    pts = spark.createDataFrame([(1, edge_lat, lon), (2, inside_lat, lon), (3, spec.lat0 - 1.0, lon)],
                                "stop_id long, stop_lat double, stop_lon double")
    got = {r["stop_id"]: r["cell_id"] for r in locate_in_grid(pts, spec, keep_outside=True).collect()}
    assert got == {1: None, 2: "cell_3_2", 3: None}


def test_fast_path_equals_bin_join(spark):
    spec = GridSpec.from_bounds(cell_size_m=500)
    cells = generate_grid(spark, spec)
    pts = spark.range(3000).select(
        F.col("id").alias("stop_id"),
        (F.lit(spec.lat0) + F.rand(1) * spec.nrow * spec.dlat).alias("stop_lat"),
        (F.lit(spec.lon0) + F.rand(2) * spec.ncol * spec.dlon).alias("stop_lon"))
    fast = locate_in_grid(pts, spec).select("stop_id", "cell_id")
    rects = cells.select("cell_id", F.col("lon_min").alias("xmin"), F.col("lon_max").alias("xmax"),
                         F.col("lat_min").alias("ymin"), F.col("lat_max").alias("ymax"))
    slow = points_in_rects(pts.withColumnRenamed("stop_lon", "x").withColumnRenamed("stop_lat", "y"), rects,
                           spec.dlat * 2).select("stop_id", "cell_id")
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_ring_predicates(spark):
    df = spark.createDataFrame([(0.5, 0.5), (1.0, 0.5), (1.5, 0.5)], "x double, y double")
    ring = rect_ring(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    got = [r[0] for r in df.select(point_in_ring(F.col("x"), F.col("y"), ring)).collect()]
    assert got == [True, False, False]  # boundary is outside
    c = df.limit(1).select(ring_centroid(ring).alias("c"), ring_is_valid(ring).alias("v")).first()
    assert abs(c["c"]["x"] - 0.5) < 1e-12 and abs(c["c"]["y"] - 0.5) < 1e-12 and c["v"]


def test_points_in_polygons_sum(spark):
    polys = spark.createDataFrame([(10, 0.0, 0.0, 2.0, 2.0), (20, 1.0, 1.0, 3.0, 3.0)],
                                  "POP long, a double, b double, c double, d double")
    polys = polys.select("POP", rect_ring(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("ring"))
    pts = spark.createDataFrame([("p", 1.5, 1.5), ("q", 0.5, 0.5), ("r", 5.0, 5.0)], "id string, x double, y double")
    got = dict(points_in_polygons(pts, polys, 1.0).groupBy("id").agg(F.sum("POP")).collect())
    assert got == {"p": 30, "q": 10}


def test_large_polygon_has_few_copies(spark):
    from cellscope.operators.spatial import points_in_rects
    rects = spark.createDataFrame([(1, 0.0, 0.0, 1000.0, 1000.0), (2, 0.0, 0.0, 1.0, 1.0), (3, 5.0, 5.0, 5.0, 5.0)],
                                  "k int, xmin double, ymin double, xmax double, ymax double")
    pts = spark.createDataFrame([("p", 0.5, 0.5), ("q", 999.0, 3.0), ("r", 1000.0, 3.0), ("s", -1.0, 3.0)], "id string, x double, y double")
    got = points_in_rects(pts, rects, 1.0)
    assert sorted((r["id"], r["k"]) for r in got.collect()) == [("p", 1), ("p", 2), ("q", 1)]
    assert set(got.columns) == {"id", "x", "y", "k", "xmin", "ymin", "xmax", "ymax"}


def test_features_read_the_fact_tables_once(spark):
    from cellscope.operators import feed
    spec = GridSpec.from_bounds(cell_size_m=500)
    inside = [spec.lat0 + 0.5 * spec.dlat, spec.lon0 + 0.5 * spec.dlon]
    stops = spark.createDataFrame([(1, *inside), (2, *inside)], "stop_id long, stop_lat double, stop_lon double")
    trips = spark.createDataFrame([(10, 5, "WK"), (11, 5, "SU"), (12, 6, "WK")], "trip_id long, route_id long, service_id string")
    times = spark.createDataFrame([(10, 1), (10, 1), (10, 2), (11, 1), (12, 2)], "trip_id long, stop_id long")
    days = ", ".join(f"{d} int" for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"))
    calendar = spark.createDataFrame([("WK", 1, 1, 1, 1, 1, 0, 0), ("SU", 0, 0, 0, 0, 0, 0, 1)], f"service_id string, {days}")
    found = feed.extract_features(generate_grid(spark, spec), stops, times, trips, calendar, spec)
    row = found.where("stop_count > 0").collect()
    assert [(r["stop_count"], r["route_count"], r["daily_trips"]) for r in row] == [(2, 2, 3)]
    assert found.where("stop_count = 0 and route_count + daily_trips > 0").count() == 0


def test_utm_round_trip(spark):
    df = spark.createDataFrame([(-43.95, -19.92)], "lon double, lat double")
    p = df.select(lonlat_to_utm(F.col("lon"), F.col("lat")).alias("p")).select("p.x", "p.y")
    back = p.select(utm_to_lonlat(F.col("x"), F.col("y")).alias("q")).first()["q"]
    assert abs(back["x"] + 43.95) < 1e-8 and abs(back["y"] + 19.92) < 1e-8
    xy = p.first()
    assert 600000 < xy["x"] < 620000 and 7790000 < xy["y"] < 7800000
