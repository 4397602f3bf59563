"""Best splits, exact-n samples of any size, binned densities."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.operators import profile as P
from ontime.operators import sampling as S
from ontime.operators import splits as L
from ontime.plans.inspect import physical_section


def brute_split(x, y):
    best = None
    for t in sorted(set(x))[:-1]:
        left = y[x <= t]
        right = y[x > t]
        gain = y.var() - (len(left) * left.var() + len(right) * right.var()) / len(y)
        if best is None or gain > best[0] + 1e-12:
            best = (gain, (t + min(x[x > t])) / 2, len(left), left.mean(), right.mean())
    return best


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_best_splits_equal_all_thresholds(spark, buckets):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 5, 600), rng.normal(size=600), np.full(600, 3.0), np.where(rng.random(600) < 0.5, 1.0, rng.random(600))])
    y = 3.0 * (x[:, 1] > 0.3) + x[:, 0] + rng.normal(size=600) * 0.1
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)] + [(None, math.nan, 1.0, 1.0, 5.0), (1.0, 1.0, 1.0, 1.0, None)]
    rows[-2] = (None, math.nan, None, None, 5.0)
    df = spark.createDataFrame(rows, "a double, b double, flat double, d double, y double").repartition(4)
    got = {r["feature"]: r for r in L.best_splits(df, ["a", "b", "flat", "d"], "y", buckets).collect()}
    assert set(got) == {"a", "b", "d"}
    for i, c in ((0, "a"), (1, "b"), (3, "d")):
        gain, threshold, n, low, high = brute_split(x[:, i], y)
        r = got[c]
        assert (r["threshold"], r["n_left"]) == (pytest.approx(threshold), n)
        assert (r["mean_left"], r["mean_right"], r["gain"]) == pytest.approx((low, high, gain))


def test_best_splits_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, y double")
    assert L.best_splits(df, ["a"], "y").count() == 0


def brute_sample(rows, n):
    h = lambda k: int(hashlib.md5(("~null~" if k is None else str(k)).encode()).hexdigest()[:8], 16)
    key = lambda v: (v is not None, v)
    return sorted(rows, key=lambda r: (h(r[0]), key(r[0]), key(r[1])))[:n]


@pytest.mark.parametrize("n", [0, 1, 10, 333, 700, 999, 1000, 5000])
def test_exact_n_with_a_hot_key(spark, n):
    rng = random.Random(1)
    # A third of the rows shares one key, others have none.
    rows = [((None if i % 7 == 0 else 5 if i % 3 == 0 else i), rng.randrange(50)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(6)
    got = sorted(map(tuple, S.sample_exact_n(df, n, ["k"]).collect()), key=str)
    assert got == sorted(brute_sample(rows, n), key=str)


def test_a_large_sample_has_no_single_merging_task(spark):
    df = spark.range(30_000, numPartitions=8).withColumn("v", F.col("id") * 2)
    out = S.sample_or_limit(df, 1 / 3, 1 << 40, ["id"])
    plan = physical_section(out)
    assert out.count() == 10_000 and "SinglePartition" not in plan and "TakeOrdered" not in plan and "Limit" not in plan
    ties = S.sample_exact_n(df.withColumn("one", F.lit(1)), 12_345, ["one"])
    assert ties.count() == 12_345 and "SinglePartition" not in physical_section(ties)
    assert {r["id"] for r in ties.collect()} == set(range(12_345))


def brute_density(x, grid):
    h = x.std(ddof=1) * len(x) ** -0.2
    g = np.linspace(x.min() - 3 * h, x.max() + 3 * h, grid)
    return g, np.exp(-0.5 * ((g[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi)), h


@pytest.mark.parametrize("tolerance", [1e-3, 1e-5, 1e-7])
def test_binned_density_keeps_its_error_bound(spark, tolerance):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=1500) * 3, rng.exponential(size=500) * 40])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (math.nan,), (math.inf,)], "v double").repartition(3)
    got = P.densities_binned(df, ["v"], 60, tolerance=tolerance).orderBy("gi").collect()
    g, want, h = brute_density(x, 60)
    assert [r["x"] for r in got] == pytest.approx(list(g))
    assert np.abs(np.array([r["density"] for r in got]) - want).max() <= tolerance / h + 1e-12


def test_binned_density_work_is_bounded_and_degenerate_columns_have_none(spark):
    df = spark.range(200_000).select(F.randn(1).alias("v"), F.lit(2.0).alias("flat"), F.lit(None).cast("double").alias("none"))
    known = P.finite_spreads(df, ["v", "flat", "none"])
    points = P.binned_counts(df, ["v", "flat", "none"], known, 1e-3)
    assert points.count() < 1500 and points.agg(F.sum("n")).first()[0] == pytest.approx(200_000)
    assert {r["column"] for r in P.densities_binned(df, ["v", "flat", "none"], 20).collect()} == {"v"}
    assert P.densities_binned(df.limit(0), ["v"], 20).count() == 0
