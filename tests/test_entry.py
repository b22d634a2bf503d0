import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 3250
    assert {"cell_id", "stop_count", "route_count", "daily_trips"} <= set(df.columns)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90
