"""The linear layer trained by gradient steps: against numpy, resumed, on awkward rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F

from ontime.operators import gradient as G
from ontime.operators import ml as M
from ontime.plans.inspect import partition_filters
from ontime.plans.registry import LABEL, MODEL_FEATURES, _train_test

FEATURES = ["a", "b"]


def table(spark, n=400, extra=()):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 2)) * [3.0, 0.5] + [10.0, -2.0]
    y = x @ [2.0, -4.0] + 7.0 + rng.normal(size=n) * 0.01
    rows = [(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows + list(extra), "k int, a double, b double, y double"), x, y


def test_a_step_equals_numpy(spark):
    df, x, y = table(spark)
    batches = G.deal_batches(df, FEATURES, "y", ["k"], 1)
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(len(x))])
    w = np.array([0.3, -1.2, 2.0])
    n, loss, slope = G.loss_and_gradient(batches.rows(spark), 2, tuple(w))
    e = z @ w - y
    assert n == len(x) and loss == pytest.approx((e ** 2).mean()) and slope == pytest.approx(2 * z.T @ e / len(x))


def test_adam_equals_numpy_and_ends_near_the_truth(spark):
    df, x, y = table(spark)
    batches = G.deal_batches(df, FEATURES, "y", ["k"], 1)
    opt = G.Optimiser(rate=0.7)
    layer = G.train_linear(spark, batches, epochs=80, opt=opt)
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(len(x))])
    w, m, v = np.zeros(3), np.zeros(3), np.zeros(3)
    for t in range(1, 81):
        g = 2 * z.T @ (z @ w - y) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.7 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    assert layer.state.weights == pytest.approx(w, rel=1e-6)
    losses = [loss for _, loss in layer.epoch_losses()]
    assert len(losses) == 80 and losses[-1] < losses[0] / 50


def test_plain_descent_lowers_the_loss_every_step(spark):
    df, *_ = table(spark)
    layer = G.train_linear(spark, G.deal_batches(df, FEATURES, "y", ["k"], 1), 15, G.Optimiser(0.2, None, None))
    losses = [r[4] for r in layer.trace]
    assert losses == sorted(losses, reverse=True)
    truth = layer.prediction()
    assert df.withColumn("p", truth).selectExpr("avg((p - y) * (p - y)) as mse").first()["mse"] < losses[-1]


def test_resumed_training_takes_the_same_steps(spark):
    df, *_ = table(spark)
    batches = G.deal_batches(df, FEATURES, "y", ["k"], 4)
    whole = G.train_linear(spark, batches, epochs=3, opt=G.Optimiser(0.1))
    first = G.train_linear(spark, batches, epochs=1, opt=G.Optimiser(0.1))
    rest = G.train_linear(spark, batches, epochs=3, opt=G.Optimiser(0.1), state=first.state)
    assert first.trace + rest.trace == whole.trace and rest.state == whole.state


def test_every_row_is_in_one_batch_and_a_step_reads_one_folder(spark):
    df, x, _ = table(spark)
    batches = G.deal_batches(df, FEATURES, "y", ["k"], 5)
    assert sum(batches.sizes.values()) == len(x) and set(batches.sizes) <= set(range(5))
    assert "batch" in partition_filters(batches.rows(spark).filter("batch = 2"))[0]


def test_missing_values_constant_features_and_no_rows(spark):
    df, x, _ = table(spark, 50, [(90, None, 1.0, 1.0), (91, 1.0, math.nan, 1.0), (92, 1.0, 1.0, None)])
    assert sum(G.deal_batches(df, FEATURES, "y", ["k"], 3).sizes.values()) == 50
    flat = G.deal_batches(df.withColumn("a", F.lit(4.0)), FEATURES, "y", ["k"], 2)
    layer = G.train_linear(spark, flat, 2, G.Optimiser(0.1))
    assert layer.state.weights[0] == 0.0 and all(math.isfinite(w) for w in layer.state.weights)
    none = G.train_linear(spark, G.deal_batches(df.limit(0), FEATURES, "y", ["k"], 2), 3)
    assert none.trace == [] and none.state.weights == (0.0, 0.0, 0.0)


def test_certificate_is_zero_at_the_fit_only(spark):
    train, _ = _train_test(spark, SF_SMALL)
    lr = M.fit_persisted(M.linear_regression(MODEL_FEATURES, reg_param=0.1), train).stages[-1]
    at = lambda w: max(abs(r["gradient"]) for r in G.squared_loss_gradient(
        train, MODEL_FEATURES, LABEL, w, lr.intercept, 0.1).collect())
    assert at(list(lr.coefficients)) < 1e-8 < 1e-4 < at([c * 1.01 for c in lr.coefficients])


def test_train_partitions_follow_the_rows():
    assert M.train_partitions(10) == 16 and M.train_partitions(100_000_001) == 101
