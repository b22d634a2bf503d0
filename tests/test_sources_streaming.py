import io
import os
import tempfile
import time
import zipfile

from pyspark.sql import functions as F

from cellscope.sources import gtfs


def _zip_feed(folder):
    path = os.path.join(folder, "feed.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("stops.txt", "stop_id,stop_lat,stop_lon\n1,-19.9,-43.9\n2,-19.8,-43.95\n")
        z.writestr("trips.txt", "trip_id,route_id,service_id\n10,5,WK\n")
    return path


def test_zip_members_and_read(spark):
    d = tempfile.mkdtemp(prefix="cellscope-test-")
    z = _zip_feed(d)
    assert [r[0] for r in gtfs.list_members(spark, z).collect()] == ["stops.txt", "trips.txt"]
    stops = gtfs.read_member(spark, z, "stops")
    assert sorted(r["stop_id"] for r in stops.collect()) == ["1", "2"]
    feed = gtfs.read_feed(spark, z, ["stops", "trips", "calendar"])
    assert set(feed) >= {"stops", "trips"}
    summary = gtfs.feed_summary({k: feed[k] for k in ("stops", "trips")}).collect()
    assert [(r["table"], r["rows"]) for r in summary] == [("stops", 2), ("trips", 1)]


def test_members_bound_by_header(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_name,stop_lon,stop_id,stop_lat,stop_code\nA,-43.9,1,-19.9,10\nB,bad,2,-19.8,11\n")
    got = {r["stop_id"]: r.asDict() for r in gtfs.read_member(spark, str(tmp_path), "stops").collect()}
    assert got["1"] == {"stop_id": "1", "stop_lat": -19.9, "stop_lon": -43.9, "stop_name": "A", "stop_code": "10"}
    assert got["2"]["stop_lon"] is None
    assert set(gtfs.read_feed(spark, str(tmp_path))) == {"stops"}
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("trips.txt", "route_id,service_id,trip_id\n5,77,10\n")
    z = str(tmp_path / "f.zip")
    assert [tuple(r) for r in gtfs.read_member(spark, z, "trips").collect()] == [("10", "5", "77")]
    assert gtfs.read_member(spark, z, "stops").count() == 0 and set(gtfs.read_feed(spark, z, ["trips", "stops"])) == {"trips"}
    sizes = gtfs.file_sizes(spark, str(tmp_path), str(tmp_path / "absent")).collect()
    assert all(r["ratio"] == 0 for r in sizes)


def test_normalized_columns_and_one_scan(spark):
    from cellscope.operators import prep, stats
    df = spark.range(5).selectExpr("id", "id * 2.0D AS a_norm", "id * 3 AS b")
    assert prep.normalized_feature_columns(df) == ["a_norm"]
    matrix = stats.corr_matrix(df)
    assert matrix.count() == 9
    assert matrix._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_load_data_dispatch(spark):
    import pytest
    with pytest.raises(ValueError):
        gtfs.load_data(spark, "/tmp/x.xlsx")
    with pytest.raises(FileNotFoundError):
        gtfs.load_parquet(spark, "/tmp/does-not-exist-dir", "stops")


def test_streaming_scoring(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from cellscope.streaming.scoring import score_stream
    train = spark.range(200).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("cell_id"),
                                    (F.col("id") / 200.0).alias("x"), (F.col("id") >= 100).cast("double").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression()]).fit(train)
    src = tempfile.mkdtemp(prefix="cellscope-stream-")
    train.select("cell_id", "x").write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    q = score_stream(spark, model, os.path.join(src, "batch1"), "cell_id string, x double", ["x"],
                     query_name="scored_test")
    q.processAllAvailable()
    q.stop()
    out = spark.sql("SELECT * FROM scored_test")
    assert out.count() == 200
    assert {"prediction", "predicted_class", "confidence"} <= set(out.columns)
    _ = io, time
