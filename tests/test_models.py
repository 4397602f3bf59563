"""Model tests: ridge closed form, metrics vs evaluator, save/load, sampling escalation."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ontime.operators import ml as M
from ontime.operators import sampling as S
from ontime.plans.registry import MODEL_FEATURES, _train_test, clean, features
from ontime.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_ridge_one_feature_closed_form(spark):
    df = features(spark, SF).select("DepDelay", "ArrDelay").dropna()
    lam = 0.1
    model = M.linear_regression(["DepDelay"], reg_param=lam, solver="normal").fit(df)
    lr = model.stages[-1]
    # Spark's normal solver standardises with population moments: the OLS slope
    # shrunk by 1 / (1 + lambda / std_pop(y)).
    s = df.agg(F.covar_pop("DepDelay", "ArrDelay").alias("cxy"), F.var_pop("DepDelay").alias("vx"),
               F.stddev_pop("ArrDelay").alias("sy"), F.avg("DepDelay").alias("mx"),
               F.avg("ArrDelay").alias("my")).first()
    beta = (s["cxy"] / s["vx"]) / (1.0 + lam / s["sy"])
    assert lr.coefficients[0] == pytest.approx(beta, rel=1e-8)
    assert lr.intercept == pytest.approx(s["my"] - beta * s["mx"], rel=1e-8, abs=1e-8)


def test_metrics_equal_evaluator(spark):
    train, test = _train_test(spark, SF)
    model = M.linear_regression(MODEL_FEATURES).fit(train)
    pred = model.transform(test)
    m = M.regression_metrics(pred).first()
    ev = RegressionEvaluator(labelCol="ArrDelay", predictionCol="prediction")
    assert m["rmse"] == pytest.approx(ev.setMetricName("rmse").evaluate(pred), rel=1e-9)
    assert m["r2"] == pytest.approx(ev.setMetricName("r2").evaluate(pred), rel=1e-9)
    assert m["mae"] == pytest.approx(ev.setMetricName("mae").evaluate(pred), rel=1e-9)


def test_save_load_same_predictions(spark):
    train, test = _train_test(spark, SF)
    model = M.linear_regression(MODEL_FEATURES).fit(train)
    path = M.save_model(model, scratch_path(spark, "model"))
    again = M.load_model(path)
    a = [r["prediction"] for r in model.transform(test).collect()]
    b = [r["prediction"] for r in again.transform(test).collect()]
    assert a == b


def test_compare_models_sorted(spark):
    train, test = _train_test(spark, SF)
    models = {"lr": M.linear_regression(MODEL_FEATURES).fit(train),
              "rf": M.random_forest(MODEL_FEATURES, num_trees=5, max_depth=4).fit(train)}
    rows = M.compare_models(models, test).collect()
    assert [r["rmse"] for r in rows] == sorted(r["rmse"] for r in rows)
    assert {r["model"] for r in rows} == {"lr", "rf"}


def test_iterative_linear_reports_loss(spark):
    train, _ = _train_test(spark, SF)
    lr = M.iterative_linear(MODEL_FEATURES, max_iter=20).fit(train).stages[-1]
    hist = lr.summary.objectiveHistory
    assert len(hist) > 1 and hist[-1] <= hist[0]


def test_model_input_requires_label(spark):
    with pytest.raises(ValueError):
        M.model_input(features(spark, SF).drop("ArrDelay"))
    mi = M.model_input(clean(spark, SF))
    assert "features_vec" in mi.columns and mi.filter("ArrDelay IS NULL").count() == 0


def test_class_weights_balance(spark):
    w = M.with_class_weight(features(spark, SF))
    tot = {r["is_delayed"]: r["w"] for r in w.groupBy("is_delayed").agg(F.sum("class_weight").alias("w")).collect()}
    assert tot[0.0] == pytest.approx(tot[1.0], rel=1e-9)


def test_class_weights_leave_out_rows_without_target(spark):
    df = spark.createDataFrame([(20.0,), (1.0,), (2.0,), (None,), (float("nan"),)], "ArrDelay double")
    w = M.with_class_weight(df)
    assert sorted((r["is_delayed"], r["class_weight"]) for r in w.collect()) == [(0.0, 0.75), (0.0, 0.75), (1.0, 1.5)]
    alone = M.with_class_weight(df.filter("ArrDelay < 5"))
    assert {r["class_weight"] for r in alone.collect()} == {1.0}


def test_sample_or_limit_size_and_order(spark):
    df = clean(spark, SF)
    keys = ["l_orderkey", "l_linenumber"]
    assert S.sample_or_limit(df, 1e-9, 50, keys).count() == 1
    assert S.sample_or_limit(df, 0.5, 50, keys).count() == 50
    assert S.sample_or_limit(df.limit(0), 0.5, 50, keys).count() == 0
    ids = spark.range(5000)
    assert S.sample_or_limit(ids, 0.5, 100, ["id"]).agg(F.max("id")).first()[0] > 4000


@pytest.mark.parametrize("n", [50, 400, 600, 1000])
def test_null_keys_are_sampled_and_split_like_any_other(spark, n):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), "id")
    order = sorted(df.select(S.hash_unit("k").alias("h"), "k", "id").collect(),
                   key=lambda r: (r["h"], r["k"] if r["k"] is not None else -1, r["id"]))
    assert {r["id"] for r in S.sample_exact_n(df, n, ["k"]).collect()} == {r["id"] for r in order[:n]}
    train, test = S.hash_split(df, 0.2, ["k"])
    assert train.count() + test.count() == 1000


def test_forest_is_the_same_for_any_input_layout(spark):
    train, test = _train_test(spark, SF)
    rows = train.collect()
    found = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, train.schema).repartition(parts)
        model = M.fit_persisted(M.random_forest(MODEL_FEATURES, num_trees=5, max_depth=4), df)
        found.add(round(M.regression_metrics(model.transform(test)).first()["rmse"], 9))
    assert len(found) == 1
