"""Sinks read back, model files, and small helpers of preparation and comparison."""

from pyspark.sql import functions as F

from cellscope.operators import ml, prep, selection, split
from cellscope.sources import io


def test_table_sinks(spark, tmp_path):
    grid = spark.createDataFrame([("a", 0.0, 1.0, 0.0, 1.0)], "cell_id string, lat_min double, lat_max double, lon_min double, lon_max double")
    io.save_table(grid, str(tmp_path / "grid"))
    assert io.load_grid(spark, str(tmp_path / "grid")).collect() == grid.collect()
    feats = spark.createDataFrame([("a", 0.1, 0.2, 0.3)], "cell_id string, stop_count_norm double, route_count_norm double, daily_trips_norm double")
    io.save_table(feats, str(tmp_path / "features"))
    assert io.load_features(spark, str(tmp_path / "features")).collect() == feats.collect()
    labels = spark.createDataFrame([("a", 1), ("b", 0)], "cell_id string, label int")
    io.save_table(labels, str(tmp_path / "labels"), ["label"])
    assert sorted(io.load_labels(spark, str(tmp_path / "labels")).select("cell_id", "label").collect()) == sorted(labels.collect())
    io.save_csv(labels, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    io.save_matrix(feats, ["stop_count_norm", "daily_trips_norm"], str(tmp_path / "m"), str(tmp_path / "n"))
    assert spark.read.parquet(str(tmp_path / "m")).first()["x"] == [0.1, 0.3]
    assert spark.read.option("header", True).csv(str(tmp_path / "n")).count() == 2


def test_splits_written_and_joined(spark, tmp_path):
    rows = spark.range(200).select(F.concat(F.lit("c"), "id").alias("cell_id"), (F.col("id") % 2).cast("int").alias("label"))
    parts = split.stratified_split(rows)
    split.save_splits(parts, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()}["test"] == 30
    joined = split.concat_splits(*[back.where(F.col("split") == s) for s in ("train", "val", "test")])
    assert joined.count() == 200


def test_model_files_scores_and_parity(spark, tmp_path):
    data = spark.range(120).select(F.concat(F.lit("c"), "id").alias("cell_id"), (F.col("id") % 7).cast("double").alias("u"),
                                   (F.col("id") % 3).cast("double").alias("v"), (F.col("id") % 7 > 3).cast("int").alias("label"))
    results, fitted = ml.train_all(data, data, ["u", "v"], models=["logistic_regression"],
                                   logistic_regression={"grid": {"C": [1.0], "max_iter": [50]}, "folds": 2})
    model = fitted["logistic_regression"]
    report = ml.parity_check(model, str(tmp_path / "model"), data).first()
    assert report["n"] == 120 and report["ok"]
    scored = ml.batch_score(ml.load_model(str(tmp_path / "model")), data, ["u", "v"])
    assert {(r["prediction"], r["predicted_class"]) for r in scored.collect()} == {(0, "underserved"), (1, "well_served")}
    ml.save_metadata(spark, str(tmp_path / "meta"), "logistic_regression", ["u", "v"], results)
    assert spark.read.json(str(tmp_path / "meta")).first()["feature_names"] == ["u", "v"]
    imp = ml.feature_importance(model, ["u", "v"])
    both = ml.compare_importance(imp, imp).collect()
    assert [r["feature"] for r in both] == ["u", "v"] and both[0]["rf"] == both[0]["gb"]
    assert all("min_samples_split" not in p for p in ml.sample_space({"a": [1, 2], "min_samples_split": [2, 5]}, 4))


def test_codes_modes_and_helpers(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("c", 5), ("c", 6)], "s string, n long")
    assert prep.fit_imputer(df, "mode") == {"s": "b"}
    codes = prep.fit_label_encoder(df, ["s"])["s"]
    assert sorted(tuple(r) for r in codes.collect()) == [("a", 0), ("b", 1), ("c", 2)]
    many = spark.range(5000).select(F.format_string("%05d", "id").alias("s"))
    coded = prep.label_encode(many, ["s"], prep.fit_label_encoder(many, ["s"]))
    assert sorted(r["s"] for r in coded.collect()) == list(range(5000))
    assert prep.missing_and_extra(df, ["n", "z"]) == (["z"], ["s"])
    named = df.select(prep.relabel("n", {1: "one"}, "other").alias("x"))
    assert [r["x"] for r in named.collect()] == ["one"] + ["other"] * 5


def test_binned_mutual_information_is_one_plan(spark):
    rows = [(float(i), float(i % 2), 1.0, i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "far double, same double, flat double, label int")
    got = {r["feature"]: r["mutual_info"] for r in selection.mutual_info_binned(df, ["far", "same", "flat"]).collect()}
    assert abs(got["same"] - 0.693147) < 1e-5 and abs(got["flat"]) < 1e-12 and abs(got["far"]) < 1e-9
    plan = selection.mutual_info_binned(df, ["far", "same", "flat"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2
