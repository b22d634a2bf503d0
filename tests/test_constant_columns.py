"""Columns that do not vary: IEEE results, as in the SQL, where ANSI division raises."""

import math

from cellscope.operators import selection, stats


def test_anova_f_of_constant_features(spark):
    rows = [(1, 320, 5.0, 0.0), (1, 320, 5.0, 1.0), (0, 320, 7.0, 4.0), (0, 320, 7.0, 5.0)]
    d = spark.createDataFrame(rows, "label int, same long, apart double, usual double")
    got = [(r["feature"], r["f_score"]) for r in selection.anova_f(d, ["same", "apart", "usual"]).collect()]
    assert [f for f, _ in got] == ["same", "apart", "usual"]
    assert math.isnan(got[0][1]) and got[1][1] == math.inf and got[2][1] == 32.0
    assert [r["feature"] for r in selection.select_k_best(d, ["usual", "apart", "same"], k=2).collect()] == ["same", "apart"]


def test_anova_f_of_one_class(spark):
    d = spark.createDataFrame([(1, 1.0), (1, 2.0)], "label int, x double")
    assert math.isnan(selection.anova_f(d, ["x"]).first()["f_score"])


def test_correlations_with_constant_columns(spark):
    d = spark.createDataFrame([(1, 320, 2.0), (2, 320, 4.0), (3, 320, None), (0, 1, 9.0)], "population long, same long, twice double")
    got = {r["metric"]: r["r"] for r in stats.pop_correlations(d, ["same", "twice"]).collect()}
    assert math.isnan(got["same"]) and abs(got["twice"] - 1) < 1e-12
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in stats.corr_matrix(d.where("same = 320"), ["population", "same"]).collect()}
    assert math.isnan(m["population", "same"]) and m["same", "same"] == 1.0
    assert stats.pop_correlations(d.limit(1), ["same"]).first()["r"] is None
