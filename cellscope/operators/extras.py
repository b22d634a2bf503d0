"""Capabilities the reference documents beyond its code path (X1-X8, X12,
X13, X17, X19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import LabelConfig
from ..session import deal, deal_join, materialize, row_tasks
from .feed import stop_cells, trip_cells, weekday_trips
from .grid import GridSpec
from .labels import generate_labels
from .ranking import exact_quantiles, one_row
from .scaling import normalize_features
from .spatial import locate_in_grid

PEAK_WINDOWS_S = [(7 * 3600, 9 * 3600), (17 * 3600, 19 * 3600)]


def peak_trips(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, calendar: DataFrame,
               spec: GridSpec) -> DataFrame:
    """Per cell, sum over stops of distinct weekday trips arriving in the
    peak windows (07-09 h, 17-19 h, end exclusive)."""
    a = F.col("arrival_s")
    peak = F.lit(False)
    for lo, hi in PEAK_WINDOWS_S:
        peak = peak | ((a >= lo) & (a < hi))
    st = stop_times.filter(peak).select("trip_id", "stop_id")
    st = st.join(weekday_trips(trips, calendar).select("trip_id"), "trip_id", "left_semi").distinct()
    per_stop = st.groupBy("stop_id").agg(F.count(F.lit(1)).alias("n"))
    return (stop_cells(stops, spec).join(per_stop, "stop_id").groupBy("cell_id")
            .agg(F.sum("n").cast("long").alias("peak_trips")))


def service_span(stop_times: DataFrame) -> DataFrame:
    """First and last arrival per stop and the span in seconds."""
    return stop_times.groupBy("stop_id").agg(F.min("arrival_s").alias("first_s"), F.max("arrival_s").alias("last_s")) \
        .withColumn("span_s", F.col("last_s") - F.col("first_s"))


def mean_headway(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Mean headway per (stop, route) in seconds. Consecutive gaps
    telescope, so the mean is (last - first) / (arrivals - 1): one
    aggregation, no per-group sort."""
    st = stop_times.select("trip_id", "stop_id", "arrival_s").join(trips.select("trip_id", "route_id"), "trip_id")
    g = st.groupBy("stop_id", "route_id").agg(F.count(F.lit(1)).alias("n"), F.min("arrival_s").alias("_lo"),
                                               F.max("arrival_s").alias("_hi"))
    return g.filter("n > 1").select("stop_id", "route_id", "n",
                                    ((F.col("_hi") - F.col("_lo")) / (F.col("n") - 1)).alias("mean_headway_s"))


#: Seconds of a time slice; a slice's distinct arrivals are put in order together.
SLICE_S = 3600


def headway_variability(stop_times: DataFrame, trips: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """Arrivals, mean headway and its sample deviation (null for one headway) per (stop, route), in seconds.

    Equal arrivals collapse to one row with a count; a (stop, route) is cut into time slices, gaps inside a slice come
    from its ordered arrivals (at most ``slice_s``), and gaps between slices from the last arrival of a slice and the first of the
    next, so a stop with very many arrivals is worked on slice by slice. Sums are whole numbers.
    """
    tasks, by = row_tasks(stop_times, trips), ["stop_id", "route_id"]
    known = stop_times.select("trip_id", "stop_id", "arrival_s").where("arrival_s IS NOT NULL")
    st = deal_join(known, trips.select("trip_id", "route_id"), tasks, "trip_id").drop("trip_id")
    st = deal(st.withColumn("_slice", F.floor(F.col("arrival_s") / slice_s)), tasks, *by, "_slice")
    seen = st.groupBy(*by, "_slice", "arrival_s").agg(F.count(F.lit(1)).alias("_c"))
    inner = Window.partitionBy(*by, "_slice").orderBy("arrival_s")
    gap = F.col("arrival_s") - F.lag("arrival_s").over(inner)
    slices = seen.withColumn("_g", gap.cast("long")).groupBy(*by, "_slice").agg(
        F.sum("_c").alias("_n"), F.min("arrival_s").alias("_first"), F.max("arrival_s").alias("_last"), F.coalesce(F.sum(F.col("_g") * F.col("_g")), F.lit(0)).alias("_q"))
    between = Window.partitionBy(*by).orderBy("_slice")  # one row for each slice
    joint = (F.col("_first") - F.lag("_last").over(between)).cast("long")
    g = deal(slices, tasks, *by).withColumn("_j", joint).groupBy(*by).agg(
        F.sum("_n").alias("n"), (F.max("_last") - F.min("_first")).cast("long").alias("_span"), F.sum(F.col("_q") + F.coalesce(F.col("_j") * F.col("_j"), F.lit(0))).alias("_q"))
    m = F.col("n") - 1
    spread = F.greatest(F.lit(0.0), (F.col("_q") - F.col("_span") * F.col("_span") / m) / (m - 1))
    return g.where("n > 1").select(*by, "n", (F.col("_span") / m).alias("mean_headway_s"), F.when(m > 1, F.sqrt(spread)).alias("headway_std_s"))


def cap_at_quantile(df: DataFrame, col: str, q: float = 0.95, out: str | None = None) -> DataFrame:
    """Values above the q-quantile replaced by it."""
    t = exact_quantiles(df, col, [q], ["_cap"])
    return df.crossJoin(one_row(t)).withColumn(out or f"{col}_capped", F.least(F.col(col), F.col("_cap"))).drop("_cap")


def underserved_population(labels: DataFrame) -> DataFrame:
    """Population living in underserved cells, and their share."""
    return labels.agg(F.sum(F.when(F.col("label") == 0, F.col("population")).otherwise(0)).cast("long")
                      .alias("underserved_population"),
                      F.sum("population").cast("long").alias("total_population"),
                      F.count(F.when(F.col("label") == 0, 1)).alias("underserved_cells"))


def route_entropy(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, spec: GridSpec) -> DataFrame:
    """Shannon entropy of the route mix of trips serving each cell:
    -sum p ln p over routes, p = distinct trips of the route / all."""
    tasks = row_tasks(stop_times, trips)
    routes = deal(trips.select("trip_id", "route_id"), tasks, "trip_id").distinct()
    ct = deal_join(trip_cells(stops, stop_times, spec, tasks), routes, tasks, "trip_id")
    per_route = ct.groupBy("cell_id", "route_id").agg(F.count(F.lit(1)).alias("n"))
    tot = per_route.groupBy("cell_id").agg(F.sum("n").alias("_t"))
    p = F.col("n") / F.col("_t")
    return (per_route.join(tot, "cell_id").groupBy("cell_id")
            .agg((-F.sum(p * F.log(p))).alias("route_entropy")))


def geojson_features(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """One GeoJSON Feature per cell (polygon, id, label, colour)."""
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in (
        ("lon_min", "lat_min"), ("lon_max", "lat_min"), ("lon_max", "lat_max"), ("lon_min", "lat_max"),
        ("lon_min", "lat_min"))])
    d = cells.join(labels.select("cell_id", "label"), "cell_id")
    feat = F.struct(F.lit("Feature").alias("type"),
                    F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
                    F.struct("cell_id", "label", F.when(F.col("label") == 1, "#2ca02c").otherwise("#d62728")
                             .alias("color")).alias("properties"))
    return d.select("cell_id", F.to_json(feat).alias("geojson"))


def grid_sweep(spark, stops: DataFrame, sizes_m: list[float], bounds: dict | None = None) -> DataFrame:
    """Per cell size, cells, occupied cells, sparsity and stops per
    occupied cell, from one pass over the stops per size."""
    parts = []
    for s in sizes_m:
        spec = GridSpec.from_bounds(bounds, s)
        occ = locate_in_grid(stops.select("stop_id", "stop_lat", "stop_lon"), spec).groupBy("cell_id").count()
        a = occ.agg(F.count(F.lit(1)).alias("occupied_cells"), F.sum("count").alias("stops_in_grid"))
        parts.append(a.select(F.lit(float(s)).alias("cell_size_m"), F.lit(spec.n_cells).cast("long").alias("cells"),
                              "occupied_cells", F.coalesce("stops_in_grid", F.lit(0)).alias("stops_in_grid"),
                              (1 - F.col("occupied_cells") / F.lit(spec.n_cells)).alias("sparsity")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def threshold_scenarios(scores: DataFrame, probs: list[float], col: str = "composite_score") -> DataFrame:
    """The score quantile and the resulting well-served share for each q."""
    names = [f"t{i}" for i in range(len(probs))]
    q = exact_quantiles(scores, col, probs, names)
    d = scores.crossJoin(one_row(q))
    a = d.agg(*[F.avg((F.col(col) >= F.col(n)).cast("double")).alias(f"s_{n}") for n in names],
              *[F.first(n).alias(n) for n in names])
    parts = [a.select(F.lit(float(p)).alias("quantile"), F.col(n).alias("threshold"),
                      F.col(f"s_{n}").alias("well_served_share")) for p, n in zip(probs, names)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feed_quality(stops: DataFrame, bounds: dict) -> DataFrame:
    """Stops inside the bounds and stops sharing an exact location."""
    inside = (F.col("stop_lat").between(bounds["lat_min"], bounds["lat_max"])
              & F.col("stop_lon").between(bounds["lon_min"], bounds["lon_max"]))
    a = stops.agg(F.count(F.lit(1)).alias("stops"), F.sum(inside.cast("long")).alias("stops_in_bounds"))
    dup = (stops.groupBy("stop_lat", "stop_lon").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
           .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("stops_at_shared_location")))
    return a.crossJoin(one_row(dup)).withColumn("share_in_bounds", F.col("stops_in_bounds") / F.col("stops"))



def buffered_bounds(stops: DataFrame, buffer_m: float = 2000.0) -> DataFrame:
    """Study bounds = stop extent widened by ``buffer_m`` metres; the
    longitude buffer uses the cosine at the extent's middle latitude."""
    from ..config import METERS_PER_DEGREE
    e = stops.agg(F.min("stop_lat").alias("a"), F.max("stop_lat").alias("b"),
                  F.min("stop_lon").alias("c"), F.max("stop_lon").alias("d"))
    blat = F.lit(buffer_m / METERS_PER_DEGREE)
    blon = F.lit(buffer_m) / (F.lit(METERS_PER_DEGREE) * F.abs(F.cos(F.radians((F.col("a") + F.col("b")) / 2))))
    return e.select((F.col("a") - blat).alias("lat_min"), (F.col("b") + blat).alias("lat_max"),
                    (F.col("c") - blon).alias("lon_min"), (F.col("d") + blon).alias("lon_max"))


def cells_in_area(cells: DataFrame, area: dict, min_share: float = 0.5) -> DataFrame:
    """Cells whose rectangle lies more than ``min_share`` inside the area
    rectangle (overlap area / cell area, in degree space)."""
    ox = F.greatest(F.lit(0.0), F.least(F.col("lon_max"), F.lit(area["lon_max"]))
                    - F.greatest(F.col("lon_min"), F.lit(area["lon_min"])))
    oy = F.greatest(F.lit(0.0), F.least(F.col("lat_max"), F.lit(area["lat_max"]))
                    - F.greatest(F.col("lat_min"), F.lit(area["lat_min"])))
    share = ox * oy / ((F.col("lon_max") - F.col("lon_min")) * (F.col("lat_max") - F.col("lat_min")))
    return cells.select("cell_id", share.alias("inside_share")).filter(F.col("inside_share") > min_share)


def class_shift_alert(before: DataFrame, after: DataFrame, max_increase: float = 0.05) -> DataFrame:
    """Alert when the share of class 0 grows by more than ``max_increase``
    between two label runs."""
    a = before.agg(F.avg((F.col("label") == 0).cast("double")).alias("share0_before"))
    b = after.agg(F.avg((F.col("label") == 0).cast("double")).alias("share0_after"))
    return a.crossJoin(b).withColumn("alert", F.col("share0_after") - F.col("share0_before") > max_increase)


def psi(a: DataFrame, b: DataFrame, col: str, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """X11: population stability index of ``col`` between two datasets over
    equal-width bins of the first one's range: sum (pa - pb) ln(pa / pb),
    shares floored at ``eps``."""
    s = a.agg(F.min(col).cast("double").alias("_mn"), F.max(col).cast("double").alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    code = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.greatest(F.floor((F.col(col) - F.col("_mn")) / w), F.lit(0)), F.lit(bins - 1))).cast("int")

    def shares(df, name):
        d = df.filter(F.col(col).isNotNull()).crossJoin(one_row(s)).select(code.alias("bin"))
        n = d.agg(F.count(F.lit(1)).alias("_n"))
        return (d.groupBy("bin").agg(F.count(F.lit(1)).alias("_c")).crossJoin(one_row(n))
                .select("bin", (F.col("_c") / F.col("_n")).alias(name)))

    spark = a.sparkSession
    allb = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    j = allb.join(shares(a, "pa"), "bin", "left").join(shares(b, "pb"), "bin", "left")
    pa = F.greatest(F.coalesce("pa", F.lit(0.0)), F.lit(eps))
    pb = F.greatest(F.coalesce("pb", F.lit(0.0)), F.lit(eps))
    return j.agg(F.sum((pa - pb) * F.log(pa / pb)).alias("psi"))


def what_if_stops(cells_pop: DataFrame, stops: DataFrame, new_stops: DataFrame, spec: GridSpec) -> DataFrame:
    """Add stops, recompute stops per cell, report the cells that go from
    no stop to served and the population they hold."""
    before = stop_cells(stops, spec).groupBy("cell_id").agg(F.count(F.lit(1)).alias("_b"))
    after = stop_cells(stops.select("stop_id", "stop_lat", "stop_lon").unionByName(
        new_stops.select("stop_id", "stop_lat", "stop_lon")), spec).groupBy("cell_id").agg(F.count(F.lit(1)).alias("_a"))
    d = cells_pop.select("cell_id", "population").join(before, "cell_id", "left").join(after, "cell_id", "left")
    gained = d.filter(F.coalesce("_b", F.lit(0)) == 0).filter(F.coalesce("_a", F.lit(0)) > 0)
    return gained.agg(F.count(F.lit(1)).alias("cells_newly_served"),
                      F.coalesce(F.sum("population"), F.lit(0)).cast("long").alias("population_gained"))


def what_if_labels(features: DataFrame, labels: DataFrame, new_stops: DataFrame, spec: GridSpec, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """Every cell whose stops or label change when stops are added: added stops, label before and after, population.

    The feed is not read again: only the new stops are placed, and their counts are added to the stored features of
    their cells (a new stop has no trips yet). Scores, thresholds and labels then follow from the changed table, since each cell's
    score depends on the mean and spread of all.
    """
    added = stop_cells(new_stops, spec).groupBy("cell_id").agg(F.count(F.lit(1)).alias("stops_added"))
    base = features.select("cell_id", "stop_count", "route_count", "daily_trips", "population").join(added, "cell_id", "left")
    base = base.withColumn("stops_added", F.coalesce("stops_added", F.lit(0)))
    changed = materialize(normalize_features(base.withColumn("stop_count", F.col("stop_count") + F.col("stops_added"))), "what-if-features")
    after = generate_labels(changed.drop("stops_added"), cfg).select("cell_id", F.col("label").alias("label_after"))
    both = changed.select("cell_id", "stops_added", "population").join(labels.select("cell_id", F.col("label").alias("label_before")), "cell_id").join(after, "cell_id")
    return both.where("stops_added > 0 OR label_before <> label_after")


def what_if_summary(changes: DataFrame) -> DataFrame:
    """Cells that become well served, cells that cease to be, and the population of both, from ``what_if_labels``."""
    up, down = F.col("label_before") < F.col("label_after"), F.col("label_before") > F.col("label_after")

    def total(cond, value):
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")

    return changes.agg(F.count(F.when(F.col("stops_added") > 0, 1)).alias("cells_with_new_stops"), total(up, F.lit(1)).alias("cells_gained"), total(down, F.lit(1)).alias("cells_lost"),
                       total(up, F.col("population")).alias("population_gained"), total(down, F.col("population")).alias("population_lost"))
