"""Forests grown from binned chunks: Spark's rules, sums that add up, predictions of the saved trees."""

from __future__ import annotations

import json
from glob import glob

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ontime.operators import ml as M
from ontime.operators.forest import BinnedForestRegressor, poisson_draws, thresholds


def rows(spark, n=4000):
    df = spark.range(n, numPartitions=3).select(
        *[(F.abs(F.xxhash64("id", F.lit(k))) % 1000 / 1000).alias(k) for k in "abcd"])
    return df.withColumn("y", F.col("a") * 10 + F.when(F.col("b") > 0.5, 3).otherwise(0) + F.col("d") * F.col("c"))


def test_passes_are_over_chunks_not_rows(spark):
    """A fit by Spark's own passes would give another class of estimator and other draws."""
    assert isinstance(M.random_forest(["a"]).getStages()[-1], BinnedForestRegressor)


def test_draws_and_thresholds():
    drawn = poisson_draws((42, 0, 3), 50, 20_000)
    share = np.bincount(drawn.ravel(), minlength=4)[:4] / drawn.size
    assert share == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=2e-3)
    assert (drawn == poisson_draws((42, 0, 3), 50, 20_000)).all() and (drawn != poisson_draws((42, 0, 4), 50, 20_000)).any()
    assert thresholds(np.array([3.0, 1, 1, 2]), 31).tolist() == [1.5, 2.5]
    assert len(thresholds(np.arange(1000.0), 31)) == 31 and not len(thresholds(np.ones(5), 31))


def test_forest_adds_up_and_predicts_like_sparks(spark, tmp_path):
    df = rows(spark)
    with M.laid_out(df, 4, "y") as laid:
        model = M.random_forest(list("abcd"), "y", num_trees=12, max_depth=5).fit(laid)
        vec = VectorAssembler(inputCols=list("abcd"), outputCol="features_vec").transform(laid)
        spark_model = RandomForestRegressor(featuresCol="features_vec", labelCol="y", numTrees=12, maxDepth=5, seed=42).fit(vec)
        rmse = [RegressionEvaluator(labelCol="y").evaluate(m.transform(x)) for m, x in ((model, laid), (spark_model, vec))]
        x = np.array([[*r] for r in laid.collect()])
        prediction = [r[0] for r in model.transform(laid).select("prediction").collect()]
    assert rmse[0] < 1.25 * rmse[1]
    model.stages[-1].write().overwrite().save(str(tmp_path / "m"))
    meta = json.loads(spark.read.text(str(tmp_path / "m" / "metadata")).first()[0])
    assert meta["numTrees"] == 12 and meta["paramMap"]["maxDepth"] == 5 and glob(str(tmp_path / "m" / "data" / "*.parquet"))
    trees = {}
    for r in spark.read.parquet(str(tmp_path / "m" / "data")).collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    total = np.zeros(len(x))
    for tree in trees.values():
        for node in tree.values():
            assert node["prediction"] == pytest.approx(node["impurityStats"][1] / node["impurityStats"][0])
            if node["leftChild"] >= 0:
                sides = [tree[node[c]]["impurityStats"] for c in ("leftChild", "rightChild")]
                assert np.allclose(np.sum(sides, axis=0), node["impurityStats"])
                left = sum(s[0] * tree[node[c]]["impurity"] for s, c in zip(sides, ("leftChild", "rightChild"), strict=True))
                assert node["gain"] == pytest.approx(node["impurity"] - left / node["impurityStats"][0], abs=1e-9) and node["gain"] > 0
        for i, row in enumerate(x):
            node = tree[0]
            while node["leftChild"] >= 0:
                split = node["split"]
                node = tree[node["leftChild" if row[split["featureIndex"]] <= split["leftCategoriesOrThreshold"][0] else "rightChild"]]
            total[i] += node["prediction"] / len(trees)
    assert np.allclose(total, prediction)
    assert len(trees) == 12 and abs(sum(t[0]["rawCount"] for t in trees.values()) / 12 - len(x)) < 200


def test_few_rows_and_one_value(spark):
    for df in (rows(spark, 3), rows(spark, 50).withColumn("y", F.lit(2.0)), rows(spark, 1)):
        model = M.random_forest(list("abcd"), "y", num_trees=3, max_depth=3).fit(df)
        low, high = df.agg(F.min("y"), F.max("y")).first()
        got = [r[0] for r in model.transform(df).select("prediction").collect()]
        assert all(min(low, 0) - 1e-9 <= p <= high + 1e-9 for p in got)
