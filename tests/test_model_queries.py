from cellscope.operators import ml
from cellscope.plans import q_ml


def test_queries_run_the_configured_searches_and_use_the_winner(spark, monkeypatch):
    asked, used = [], []
    families = list(ml.TRAINERS)

    def train_all(train, val, cols=None, models=None, **kw):
        asked.append((models or families, kw))
        rows = [(m, "{}", 0.5, 0.9 if m == "gradient_boosting" else 0.4, 1.0) for m in models or families]
        return spark.createDataFrame(rows, "model string, params string, cv_f1 double, val_f1 double, train_seconds double"), {m: m for m in families}

    test = spark.createDataFrame([(1, 1)], "cell_id long, label int")
    monkeypatch.setattr(q_ml, "_train_val_test", lambda c: (None, None, test))
    monkeypatch.setattr(q_ml, "model_table", lambda c: test)
    monkeypatch.setattr(ml, "train_all", train_all)
    monkeypatch.setattr(ml, "evaluate", lambda model, te, name: used.extend([model, name]))
    monkeypatch.setattr(ml, "batch_score", lambda model, df, cols: used.append(model))
    monkeypatch.setattr(ml, "feature_importance", lambda model, cols: used.append(model))
    q_ml.q_train_rf(None)
    q_ml.q_train_gbt(None)
    assert q_ml.q_best_model(None).first()["model"] == "gradient_boosting"
    q_ml.q_test_metrics(None)
    q_ml.q_batch_score(None)
    q_ml.q_feature_importance(None)
    assert asked == [(["random_forest"], {}), (["gradient_boosting"], {})] + [(families, {})] * 4
    assert (ml.RF_N_ITER, ml.GBT_N_ITER, ml.CV_FOLDS) == (20, 15, 5) and used == ["gradient_boosting"] * 4
