"""Source/sink round trips and the documented extra analyses (S2-S6, S16, X*)."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BOUNDS
from ..functions.seeded import sql_lit as L
from ..operators import extras as ex
from ..operators.scaling import minmax
from ..session import ensure_checkpoint_dir
from ..sources import archive, gtfs
from .context import Ctx
from .q_labels import LABEL_CTES, VIEWS
from .queries import _IN_CELL, _SERVED_AREA, _WD_TRIPS, V, query, served_area


def _scratch(c: Ctx, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(c.spark), f"{name}-{uuid.uuid4().hex[:8]}")


@query("feed_summary", V(
    "SELECT * FROM (SELECT 'stop_times' AS \"table\", count(*) AS rows, 3 AS n_columns, "
    "'trip_id,stop_id,stop_sequence' AS columns FROM stop_times UNION ALL SELECT 'trips', count(*), 3, "
    "'trip_id,route_id,service_id' FROM trips UNION ALL SELECT 'stops', count(*), 3, 'stop_id,stop_lat,stop_lon' "
    "FROM stops) t", "stops", "trips", "stop_times"))
def q_feed_summary(c: Ctx) -> DataFrame:
    """Rows and columns per feed table."""
    out = gtfs.feed_summary({"stops": c.stops, "trips": c.trips, "stop_times": c.stop_times})
    return out.withColumn("n_columns", F.col("n_columns").cast("int"))


@query("csv_roundtrip", V("SELECT stop_id, round(stop_lat, 9) AS stop_lat, round(stop_lon, 9) AS stop_lon "
                          "FROM stops", "stops"))
def q_csv_roundtrip(c: Ctx) -> DataFrame:
    """S2 + S4 + S5: stops written as a CSV feed member, read back with the
    declared schema, converted to Parquet and loaded by name."""
    folder = _scratch(c, "feed")
    c.stops.write.mode("overwrite").option("header", True).csv(os.path.join(folder, "stops.txt"))
    tables = {"stops": gtfs.read_member(c.spark, folder, "stops")}
    pq = _scratch(c, "feed-parquet")
    gtfs.to_parquet(tables, pq)
    back = gtfs.load_parquet(c.spark, pq, "stops")
    return back.select(F.col("stop_id").cast("long").alias("stop_id"), F.round("stop_lat", 9).alias("stop_lat"), F.round("stop_lon", 9).alias("stop_lon"))


#: Ids with letters and with leading zeros, and a coordinate that is no number on every 97th stop.
_ODD_STOPS = ("SELECT CASE WHEN stop_id % 7 = 0 THEN 'A' || CAST(stop_id AS VARCHAR) ELSE lpad(CAST(stop_id AS VARCHAR), 8, '0') END AS stop_id, "
              "CASE WHEN stop_id % 97 = 0 THEN NULL ELSE stop_lat END AS stop_lat, stop_lon, 'C' || CAST(stop_id % 13 AS VARCHAR) AS stop_code, "
              "CASE WHEN stop_id % 97 = 0 THEN 'stop_lat' END AS bad FROM stops")


def _archived_feed(c: Ctx) -> str:
    """A folder of archives with the members stops and trips, written by a task for each partition."""
    folder = os.path.join(_scratch(c, "feed-archives"), "feed.zips")
    number = F.col("stop_id").cast("string")
    stops = c.stops.select(F.when(F.col("stop_id") % 7 == 0, F.concat(F.lit("A"), number)).otherwise(F.lpad(number, 8, "0")).alias("stop_id"),
                           F.concat(F.lit("C"), (F.col("stop_id") % 13).cast("string")).alias("stop_code"),
                           F.when(F.col("stop_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("stop_lat").cast("string")).alias("stop_lat"), "stop_lon")
    archive.write_archive(stops.repartition(4), folder, "google_transit/stops")
    archive.write_archive(c.trips.repartition(4), folder, "trips")
    return folder


@query("archive_feed", V(f"SELECT stop_id, round(stop_lat, 9) AS stop_lat, round(stop_lon, 9) AS stop_lon, stop_code, bad FROM ({_ODD_STOPS}) t", "stops"))
def q_archive_feed(c: Ctx) -> DataFrame:
    """A member in a folder of several archives, text ids, an undeclared column, bad records named."""
    back = gtfs.read_member(c.spark, _archived_feed(c), "stops", keep_bad=True)
    return back.select("stop_id", F.round("stop_lat", 9).alias("stop_lat"), F.round("stop_lon", 9).alias("stop_lon"), "stop_code", F.col(archive.BAD).alias("bad"))


@query("archive_quality", V(f"SELECT 'stops' AS table, count(*) AS records, count(bad) AS bad FROM ({_ODD_STOPS}) t UNION ALL "
                            "SELECT 'trips', count(*), 0 FROM trips", "stops", "trips"))
def q_archive_quality(c: Ctx) -> DataFrame:
    """S2 + S3: records and bad records of every member of the archives."""
    folder = _archived_feed(c)
    return gtfs.bad_records(c.spark, folder, sorted(gtfs.read_feed(c.spark, folder)))


_PEAK = " OR ".join(f"(arrival_s >= {lo} AND arrival_s < {hi})" for lo, hi in ex.PEAK_WINDOWS_S)


@query("peak_trips", V(
    f"SELECT c.cell_id, CAST(sum(p.n) AS BIGINT) AS peak_trips FROM stops s {_IN_CELL} JOIN (SELECT stop_id, "
    f"count(DISTINCT trip_id) AS n FROM stop_times_arr WHERE ({_PEAK}) AND trip_id IN ({_WD_TRIPS}) "
    f"GROUP BY stop_id) p ON p.stop_id = s.stop_id GROUP BY c.cell_id",
    "stops", "cells", "stop_times_arr", "trips", "calendar"))
def q_peak_trips(c: Ctx) -> DataFrame:
    """Weekday peak-hour trips per cell."""
    return ex.peak_trips(c.stops, c.stop_times_arr, c.trips, c.calendar, c.spec)


@query("service_span", V("SELECT stop_id, min(arrival_s) AS first_s, max(arrival_s) AS last_s, "
                         "max(arrival_s) - min(arrival_s) AS span_s FROM stop_times_arr GROUP BY stop_id",
                         "stop_times_arr"))
def q_service_span(c: Ctx) -> DataFrame:
    """Service span per stop."""
    return ex.service_span(c.stop_times_arr)


@query("mean_headway", V(
    "SELECT st.stop_id, t.route_id, count(*) AS n, round((max(arrival_s) - min(arrival_s)) / CAST(count(*) - 1 AS "
    "DOUBLE), 6) AS mean_headway_s FROM stop_times_arr st JOIN trips t ON t.trip_id = st.trip_id "
    "GROUP BY st.stop_id, t.route_id HAVING count(*) > 1", "stop_times_arr", "trips"))
def q_mean_headway(c: Ctx) -> DataFrame:
    """Mean headway per (stop, route)."""
    return ex.mean_headway(c.stop_times_arr, c.trips).withColumn("mean_headway_s", F.round("mean_headway_s", 6))


@query("headway_variability", V(
    "SELECT stop_id, route_id, count(*) AS n, round((max(arrival_s) - min(arrival_s)) / CAST(count(*) - 1 AS DOUBLE), 6) AS mean_headway_s, "
    "round(stddev_samp(gap), 5) AS headway_std_s FROM (SELECT st.stop_id, t.route_id, arrival_s, arrival_s - lag(arrival_s) OVER (PARTITION BY st.stop_id, t.route_id "
    "ORDER BY arrival_s) AS gap FROM stop_times_arr st JOIN trips t ON t.trip_id = st.trip_id) g GROUP BY 1, 2 HAVING count(*) > 1", "stop_times_arr", "trips"))
def q_headway_variability(c: Ctx) -> DataFrame:
    """Mean headway and its deviation per (stop, route)."""
    d = ex.headway_variability(c.stop_times_arr, c.trips)
    return d.withColumns({"mean_headway_s": F.round("mean_headway_s", 6), "headway_std_s": F.round("headway_std_s", 5)})


@query("capped_trips", V(
    "SELECT cell_id, daily_trips, round(least(daily_trips, cap), 6) AS daily_trips_capped FROM fpop, "
    "(SELECT quantile_cont(daily_trips, 0.95) AS cap FROM fpop) q", *VIEWS, ctes=LABEL_CTES[:2]))
def q_capped_trips(c: Ctx) -> DataFrame:
    """Daily trips capped at the 95th percentile."""
    d = ex.cap_at_quantile(c.features_pop.select("cell_id", "daily_trips"), "daily_trips", 0.95)
    return d.withColumn("daily_trips_capped", F.round("daily_trips_capped", 6))


@query("underserved_population", V(
    "SELECT CAST(sum(CASE WHEN label = 0 THEN population ELSE 0 END) AS BIGINT) AS underserved_population, "
    "CAST(sum(population) AS BIGINT) AS total_population, count(*) FILTER (WHERE label = 0) AS underserved_cells "
    "FROM lbl", *VIEWS, ctes=LABEL_CTES))
def q_underserved_population(c: Ctx) -> DataFrame:
    """Population in underserved cells."""
    return ex.underserved_population(c.labels)


@query("route_entropy", V(
    f"SELECT cell_id, round(-sum(p * ln(p)), 6) AS route_entropy FROM (SELECT cell_id, n / CAST(sum(n) OVER "
    f"(PARTITION BY cell_id) AS DOUBLE) AS p FROM (SELECT c.cell_id, t.route_id, count(DISTINCT st.trip_id) AS n "
    f"FROM stops s {_IN_CELL} JOIN stop_times st ON st.stop_id = s.stop_id JOIN trips t ON t.trip_id = st.trip_id "
    f"GROUP BY c.cell_id, t.route_id) a) b GROUP BY cell_id", "stops", "cells", "stop_times", "trips"))
def q_route_entropy(c: Ctx) -> DataFrame:
    """Shannon entropy of routes per cell."""
    return ex.route_entropy(c.stops, c.stop_times, c.trips, c.spec).withColumn(
        "route_entropy", F.round("route_entropy", 6))


@query("geojson_cells")
def q_geojson_cells(c: Ctx) -> DataFrame:
    """GeoJSON feature per cell with class colour."""
    return ex.geojson_features(c.cells, c.labels)


#: Cell sizes in metres that the sweep compares.
SWEEP = (100, 150, 200, 250, 500)


@query("grid_sweep", V(" UNION ALL ".join(
    f"SELECT CAST({s} AS DOUBLE) AS cell_size_m, CAST({sp.n_cells} AS BIGINT) AS cells, count(*) AS occupied_cells, "
    f"sum(k) AS stops_in_grid, 1 - count(*) / CAST({sp.n_cells} AS DOUBLE) AS sparsity FROM (SELECT c.cell_id, "
    f"count(*) AS k FROM stops s JOIN ({__import__('cellscope.plans.sqlviews', fromlist=['x']).cells_sql(sp)}) c "
    f"ON s.stop_lat > c.lat_min AND s.stop_lat < c.lat_max AND s.stop_lon > c.lon_min AND s.stop_lon < c.lon_max "
    f"GROUP BY c.cell_id) g" for s, sp in [(s, __import__('cellscope.operators.grid', fromlist=['x']).GridSpec
                                            .from_bounds(cell_size_m=s)) for s in SWEEP]), "stops"))
def q_grid_sweep(c: Ctx) -> DataFrame:
    """Occupancy and sparsity of the grid at the sizes of SWEEP."""
    return ex.grid_sweep(c.spark, c.stops, list(SWEEP))


_TS = [0.5, 0.7, 0.8, 0.9]


@query("threshold_scenarios", V(" UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS quantile, round(t, 6) AS threshold, round(avg(CASE WHEN composite_score >= t "
    f"THEN 1.0 ELSE 0.0 END), 6) AS well_served_share FROM sc, (SELECT quantile_cont(composite_score, {L(q)}) AS t "
    f"FROM sc) x GROUP BY t" for q in _TS), *VIEWS, ctes=LABEL_CTES[:4]))
def q_threshold_scenarios(c: Ctx) -> DataFrame:
    """Class balance at several score thresholds."""
    from ..operators.labels import composite_score
    sc = c.features_norm.select(composite_score().alias("composite_score"))
    out = ex.threshold_scenarios(sc, _TS)
    return out.withColumns({"threshold": F.round("threshold", 6), "well_served_share": F.round("well_served_share", 6)})


@query("feed_quality", V(
    f"SELECT count(*) AS stops, count(*) FILTER (WHERE stop_lat BETWEEN {L(BOUNDS['lat_min'])} AND "
    f"{L(BOUNDS['lat_max'])} AND stop_lon BETWEEN {L(BOUNDS['lon_min'])} AND {L(BOUNDS['lon_max'])}) "
    f"AS stops_in_bounds, (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM stops GROUP BY stop_lat, "
    f"stop_lon HAVING count(*) > 1) d) AS stops_at_shared_location, round(count(*) FILTER (WHERE stop_lat BETWEEN "
    f"{L(BOUNDS['lat_min'])} AND {L(BOUNDS['lat_max'])} AND stop_lon BETWEEN {L(BOUNDS['lon_min'])} AND "
    f"{L(BOUNDS['lon_max'])}) / CAST(count(*) AS DOUBLE), 6) AS share_in_bounds FROM stops", "stops"))
def q_feed_quality(c: Ctx) -> DataFrame:
    """Stops inside the study area and stops sharing a location."""
    q = ex.feed_quality(c.stops, BOUNDS)
    return q.withColumn("share_in_bounds", F.round("share_in_bounds", 6)).withColumn(
        "stops_at_shared_location", F.col("stops_at_shared_location").cast("long"))


@query("minmax_features", V(
    "SELECT cell_id, " + ", ".join(
        f"round(CASE WHEN max({x}) OVER () = min({x}) OVER () THEN 0.0 ELSE ({x} - min({x}) OVER ()) / "
        f"CAST(max({x}) OVER () - min({x}) OVER () AS DOUBLE) END, 6) AS {x}_mm"
        for x in ("stop_count", "route_count", "daily_trips")) + " FROM feat", *VIEWS, ctes=LABEL_CTES[:1]))
def q_minmax_features(c: Ctx) -> DataFrame:
    """Min-max scaling of the transit features."""
    cols = ["stop_count", "route_count", "daily_trips"]
    d = minmax(c.features.select("cell_id", *cols), cols)
    return d.select("cell_id", *[F.round(f"{x}_mm", 6).alias(f"{x}_mm") for x in cols])


@query("buffered_bounds", V(
    f"SELECT round(a - {L(2000.0 / 111320.0)}, 6) AS lat_min, round(b + {L(2000.0 / 111320.0)}, 6) AS lat_max, "
    f"round(c - {L(2000.0)} / ({L(111320.0)} * abs(cos(radians((a + b) / 2)))), 6) AS lon_min, "
    f"round(d + {L(2000.0)} / ({L(111320.0)} * abs(cos(radians((a + b) / 2)))), 6) AS lon_max FROM "
    f"(SELECT min(stop_lat) AS a, max(stop_lat) AS b, min(stop_lon) AS c, max(stop_lon) AS d FROM stops) e",
    "stops"))
def q_buffered_bounds(c: Ctx) -> DataFrame:
    """Stop extent plus a 2 km buffer."""
    b = ex.buffered_bounds(c.stops, 2000.0)
    return b.select(*[F.round(x, 6).alias(x) for x in b.columns])


_OX = (f"greatest(CAST(0 AS DOUBLE), least(lon_max, {L(BOUNDS['lon_max'])}) - greatest(lon_min, "
       f"{L(BOUNDS['lon_min'])}))")
_OY = (f"greatest(CAST(0 AS DOUBLE), least(lat_max, {L(BOUNDS['lat_max'])}) - greatest(lat_min, "
       f"{L(BOUNDS['lat_min'])}))")


@query("cells_in_area", V(
    f"SELECT cell_id, round(s, 6) AS inside_share FROM (SELECT cell_id, {_OX} * {_OY} / ((lon_max - lon_min) * "
    f"(lat_max - lat_min)) AS s FROM ({_SERVED_AREA}) g) t WHERE s > 0.5", "stops", "cells"))
def q_cells_in_area(c: Ctx) -> DataFrame:
    """Cells of the feed's extent more than half inside the study bounds."""
    return ex.cells_in_area(served_area(c), BOUNDS).withColumn("inside_share", F.round("inside_share", 6))


@query("class_shift_alert", V(
    "SELECT round(b0, 6) AS share0_before, round(a0, 6) AS share0_after, a0 - b0 > 0.05 AS alert FROM "
    "(SELECT avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) AS b0 FROM lbl) x, (SELECT avg(CASE WHEN composite_score "
    "< threshold_used AND population > population_median THEN 1.0 ELSE 0.0 END) AS a0 FROM lbl) y",
    *VIEWS, ctes=LABEL_CTES))
def q_class_shift_alert(c: Ctx) -> DataFrame:
    """Class-0 share of noisy labels (before) vs noise-free labels (after)."""
    from ..config import LabelConfig
    from ..operators.labels import label_frame
    plain = label_frame(c.features_pop, LabelConfig(noise=False)).select("cell_id", "label")
    out = ex.class_shift_alert(c.labels, plain)
    return out.select(F.round("share0_before", 6).alias("share0_before"),
                      F.round("share0_after", 6).alias("share0_after"), "alert")


@query("feature_drift", V(
    "SELECT round(sum((pa - pb) * ln(pa / pb)), 6) AS psi FROM (SELECT b.range AS bin, greatest(coalesce(x.p, 0.0), "
    "0.0001) AS pa, greatest(coalesce(y.p, 0.0), 0.0001) AS pb FROM range(10) b "
    "LEFT JOIN (SELECT bin, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM (SELECT " + (
        "CAST(CASE WHEN (mx - mn) / 10.0 = 0 THEN 0 ELSE least(greatest(floor((f.daily_trips - mn) / ((mx - mn) / "
        "CAST(10 AS DOUBLE))), 0), 9) END AS INTEGER) AS bin") + " FROM fpop f JOIN splits s ON s.cell_id = f.cell_id, "
    "rng WHERE s.split = 'train') t GROUP BY bin) x ON x.bin = b.range "
    "LEFT JOIN (SELECT bin, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM (SELECT " + (
        "CAST(CASE WHEN (mx - mn) / 10.0 = 0 THEN 0 ELSE least(greatest(floor((f.daily_trips - mn) / ((mx - mn) / "
        "CAST(10 AS DOUBLE))), 0), 9) END AS INTEGER) AS bin") + " FROM fpop f JOIN splits s ON s.cell_id = f.cell_id, "
    "rng WHERE s.split = 'test') t GROUP BY bin) y ON y.bin = b.range) z", *VIEWS,
    ctes=__import__("cellscope.plans.q_prep", fromlist=["x"]).SPLIT_CTES + [
        "rng AS (SELECT CAST(min(f.daily_trips) AS DOUBLE) AS mn, CAST(max(f.daily_trips) AS DOUBLE) AS mx FROM fpop f "
        "JOIN splits s ON s.cell_id = f.cell_id WHERE s.split = 'train')"]))
def q_feature_drift(c: Ctx) -> DataFrame:
    """X11: PSI of daily trips between the train and test splits."""
    from ..operators import split as sp
    s = sp.stratified_split(sp.merge_features_labels(c.features_pop, c.labels).select("cell_id", "label"))
    d = c.features_pop.select("cell_id", "daily_trips").join(s.select("cell_id", "split"), "cell_id")
    out = ex.psi(d.filter("split = 'train'"), d.filter("split = 'test'"), "daily_trips")
    return out.select(F.round("psi", 6).alias("psi"))


def _new_stops_sql() -> str:
    from ..functions.seeded import sql_uniform as U
    from ..sources import fixtures as fx
    return (f"SELECT s_suppkey + 1000000000000 AS stop_id, {L(fx.BASE_LAT)} + {U('new-stop-lat', 's_suppkey')} * "
            f"{L(fx.SPAN_LAT)} AS stop_lat, {L(fx.BASE_LON)} + {U('new-stop-lon', 's_suppkey')} * {L(fx.SPAN_LON)} "
            f"AS stop_lon FROM supplier")


@query("what_if_stops", V(
    f"SELECT count(*) AS cells_newly_served, CAST(coalesce(sum(f.population), 0) AS BIGINT) AS population_gained "
    f"FROM fpop f LEFT JOIN (SELECT c.cell_id, count(*) AS n FROM stops s {_IN_CELL} GROUP BY c.cell_id) b "
    f"ON b.cell_id = f.cell_id LEFT JOIN (SELECT c.cell_id, count(*) AS n FROM allstops s {_IN_CELL} GROUP BY "
    f"c.cell_id) a ON a.cell_id = f.cell_id WHERE coalesce(b.n, 0) = 0 AND coalesce(a.n, 0) > 0", *VIEWS,
    ctes=LABEL_CTES[:2] + [f"allstops AS (SELECT * FROM stops UNION ALL {_new_stops_sql()})"]))
def q_what_if_stops(c: Ctx) -> DataFrame:
    """Cells newly served and population gained when supplier-sited stops are added."""
    from ..sources import fixtures as fx
    return ex.what_if_stops(c.features_pop, c.stops, fx.new_stops(c.spark, c.sf_dir), c.spec)


def _after(cte: str) -> str:
    """A step of the label chain, over the feed with the new stops."""
    named = re.sub(r"\b(feat|fpop|fn|sc|st|nz|md|lb0|lbl)\b", r"\1_after", cte)
    return named.replace("FROM stops s", "FROM allstops s")


_CHANGED_SQL = (f"SELECT f.cell_id, coalesce(n.k, 0) AS stops_added, f.population, b.label AS label_before, a.label AS label_after FROM fpop f JOIN lbl b ON b.cell_id = f.cell_id "
                f"JOIN lbl_after a ON a.cell_id = f.cell_id LEFT JOIN (SELECT c.cell_id, count(*) AS k FROM ({_new_stops_sql()}) s {_IN_CELL} GROUP BY c.cell_id) n ON n.cell_id = f.cell_id "
                "WHERE coalesce(n.k, 0) > 0 OR b.label <> a.label")
_CHANGE_CTES = LABEL_CTES + [f"allstops AS (SELECT * FROM stops UNION ALL {_new_stops_sql()})", *map(_after, LABEL_CTES)]


def _what_if(c: Ctx) -> DataFrame:
    from ..sources import fixtures as fx
    return ex.what_if_labels(c.features_pop, c.labels, fx.new_stops(c.spark, c.sf_dir), c.spec)


@query("what_if_labels", V(_CHANGED_SQL, *VIEWS, ctes=_CHANGE_CTES))
def q_what_if_labels(c: Ctx) -> DataFrame:
    """Cells with new stops or another label after adding stops (the SQL reruns everything)."""
    return _what_if(c).select("cell_id", "stops_added", "population", "label_before", "label_after")


@query("what_if_summary", V(
    "SELECT count(*) FILTER (WHERE stops_added > 0) AS cells_with_new_stops, count(*) FILTER (WHERE label_before < label_after) AS cells_gained, "
    "count(*) FILTER (WHERE label_before > label_after) AS cells_lost, CAST(coalesce(sum(population) FILTER (WHERE label_before < label_after), 0) AS BIGINT) AS population_gained, "
    f"CAST(coalesce(sum(population) FILTER (WHERE label_before > label_after), 0) AS BIGINT) AS population_lost FROM ({_CHANGED_SQL}) w", *VIEWS, ctes=_CHANGE_CTES))
def q_what_if_summary(c: Ctx) -> DataFrame:
    """Cells and population gained and lost by adding stops."""
    return ex.what_if_summary(_what_if(c))
