"""Shuffles of the feed queries take their number of tasks from the rows, with the same results."""

import pytest

from cellscope import session
from cellscope.operators import extras as ex
from cellscope.operators import feed
from cellscope.operators.grid import GridSpec, generate_grid
from cellscope.sources import fixtures as fx

SPEC = GridSpec.from_bounds(cell_size_m=5000)


@pytest.fixture(scope="module")
def tables(spark):
    lat, lon = fx.BASE_LAT + 0.05, fx.BASE_LON + 0.05
    stops = [(i, lat + i * 0.01, lon + i * 0.01) for i in range(12)] + [(3, lat + 0.03, lon + 0.03), (None, lat, lon)]
    names = [r[0] for r in fx.CALENDAR_ROWS]
    trips = [(t, t % 4, names[t % 5]) for t in range(30)] + [(7, 3, names[2]), (8, 1, names[3]), (None, 1, names[0])]
    times = [(t, (t * 7 + s * s) % 13, s, (t * 911 + s * 1777) % 60000) for t in range(32) for s in range(6)]
    times += times[:20] + [(None, 3, 1, 5), (5, None, 1, 5), (5, 3, 1, None)]
    return (spark.createDataFrame(stops, "stop_id long, stop_lat double, stop_lon double"),
            spark.createDataFrame(trips, "trip_id long, route_id long, service_id string"),
            spark.createDataFrame(times, "trip_id long, stop_id long, stop_sequence int, arrival_s int"), fx.calendar(spark))


def asked(spark, tables):
    stops, trips, times, calendar = tables
    return {"features": feed.extract_features(generate_grid(spark, SPEC), stops, times, trips, calendar, SPEC),
            "daily_trips": feed.daily_trips(stops, times, trips, calendar, SPEC),
            "daily_trips_distinct": feed.daily_trips_distinct(stops, times, trips, calendar, SPEC),
            "route_entropy": ex.route_entropy(stops, times, trips, SPEC),
            "headway_variability": ex.headway_variability(times, trips)}


def rows(df):
    return sorted(tuple(f"{v:.9f}" if isinstance(v, float) else str(v) for v in r) for r in df.collect())


def test_tasks_follow_the_rows_and_results_stay(spark, tables, monkeypatch):
    plain = {k: rows(d) for k, d in asked(spark, tables).items()}
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    n = session.row_tasks(*tables[1:3])
    assert n == -(-tables[2].count() // 10)
    for k, d in asked(spark, tables).items():
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert f", {n}), REPARTITION_BY_NUM" in plan, k
        assert rows(d) == plain[k] and plain[k], k
