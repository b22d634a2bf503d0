"""Plans of the feed aggregates: the fact tables are never dealt by a column of few values."""

import pytest

from cellscope.operators import feed
from cellscope.plans.context import Ctx

SF = "/root/testdata/sf0.01"


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_on_services(spark):
    c = Ctx(spark, SF)
    for df in (feed.weekday_trips(c.trips, c.calendar), c.features):
        plan = _executed(df)
        assert "BroadcastHashJoin [service_id" in plan and "SortMergeJoin [service_id" not in plan


def test_services_beyond_the_broadcast_limit(spark, monkeypatch):
    c = Ctx(spark, SF)
    want = feed.weekday_trips(c.trips, c.calendar).count()
    monkeypatch.setattr(feed, "broadcast_checked", lambda df: df)
    assert feed.weekday_trips(c.trips, c.calendar).count() == want > 0


@pytest.mark.parametrize("levels", [1, 2])
def test_quantiles_shuffle_no_distinct_values(spark, monkeypatch, levels):
    """Only buckets and the values of the wanted ones are exchanged, never all distinct values."""
    from cellscope.operators import ranking, stats

    if levels == 2:
        monkeypatch.setattr(ranking, "TWO_LEVEL_BYTES", ranking.ONE_LEVEL_BYTES)
    n = 200_000
    df = spark.range(n, numPartitions=4).selectExpr("(id * 7919) % 200003 / 3 AS x", "CAST(id % 2 AS INT) AS g", "(id * 31) % 1009 AS y")
    for plan in (stats.quantiles(df, "x", [0.25, 0.9]), stats.describe(df, ["x", "y"]), stats.box_stats(df, "x", "g")):
        plan.collect()
        tree = plan._jdf.queryExecution().executedPlan()
        sizes = _shuffled(tree)
        assert sizes and max(sizes) < n // 20, sizes
    by_class = {r["group"]: r["median"] for r in stats.box_stats(df, "x", "g").collect()}
    rows = df.collect()
    for g in (0, 1):
        v = sorted(r["x"] for r in rows if r["g"] == g)
        assert abs(by_class[str(g)] - (v[len(v) // 2 - 1] + v[len(v) // 2]) / 2) < 1e-9
    few = ranking.take_smallest(df.limit(50).selectExpr("x", "CAST(0.5 AS DOUBLE) AS u", "g"), "u", spark.createDataFrame([(0, 3), (1, 0)], "g int, _q long"), ["g"], "x", "o")
    assert sum(r["o"] for r in few.collect()) == 3  # all keys are equal


def _shuffled(plan):
    """Rows written by each exchange of a finished plan."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    return found
