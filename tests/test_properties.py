"""Property tests: invariants that must hold for any input."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ontime.operators import ml as M
from ontime.operators import profile as P
from ontime.operators import quantiles as Q
from ontime.operators import rates as R
from ontime.operators import sampling as S
from ontime.plans.registry import clean, features

SF = "/root/testdata/sf0.001"
HSET = settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
                suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.integers(min_value=-60, max_value=200), min_size=1, max_size=60)


def _disc(xs, p):
    xs = sorted(xs)
    k = max(1, math.ceil(len(xs) * p))
    return float(xs[k - 1])


@HSET
@given(xs=values, buckets=st.sampled_from([1, 2, 4, 64]))
def test_exact_quantiles_match_definition(spark, xs, buckets):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["probability"]: r["value"] for r in Q.quantiles_disc(df, ["x"], probs, buckets=buckets).collect()}
    for p in probs:
        assert got[p] == _disc(xs, p)
    cont = {r["probability"]: r["value"] for r in Q.quantiles_cont(df, ["x"], probs, buckets=buckets).collect()}
    for p in probs:
        assert cont[p] == pytest.approx(float(np.quantile(np.array(xs, dtype=float), p)), abs=1e-9)


@HSET
@given(xs=st.lists(st.one_of(st.none(), st.integers(-40, 40)), min_size=0, max_size=40))
def test_bucket_counts_and_shares(spark, xs):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in xs], "ArrDelay double")
    rows = R.bucket_summary(df).collect()
    assert sum(r["n"] for r in rows) == len(xs)
    if xs:
        assert abs(sum(r["pct"] for r in rows) - 100.0) <= 0.01


def test_hash_split_disjoint_complete_repeatable(spark):
    df = clean(spark, SF)
    train, test = S.hash_split(df, 0.2, ["l_orderkey", "l_linenumber"])
    n, a, b = df.count(), train.count(), test.count()
    assert a + b == n and 0.15 < b / n < 0.25
    again = S.hash_split(df.repartition(3), 0.2, ["l_orderkey", "l_linenumber"])[1]
    assert sorted(map(tuple, test.collect())) == sorted(map(tuple, again.collect()))


def test_random_split_complete(spark):
    df = clean(spark, SF)
    parts = S.random_split(df, [0.8, 0.2], seed=42)
    assert sum(p.count() for p in parts) == df.count()


def test_sample_exact_n_independent_of_layout(spark):
    df = clean(spark, SF)
    a = S.sample_exact_n(df, 100, ["l_orderkey", "l_linenumber"]).collect()
    b = S.sample_exact_n(df.repartition(5), 100, ["l_orderkey", "l_linenumber"]).collect()
    assert len(a) == 100 and sorted(a) == sorted(b)  # a sample is in no particular order


def test_scaled_columns_mean0_std1(spark):
    cols = ["DepDelay", "Distance", "TaxiIn", "TaxiOut"]
    df = features(spark, SF).select(*cols).dropna()
    scaled, _ = M.standard_scale(df, cols)
    out = M.unpack_vector(scaled, "scaled_features", cols, prefix="z_")
    stats = out.agg(*[F.avg(f"z_{c}").alias(f"m{c}") for c in cols],
                    *[F.stddev_samp(f"z_{c}").alias(f"s{c}") for c in cols]).first()
    for c in cols:
        assert abs(stats[f"m{c}"]) < 1e-9 and abs(stats[f"s{c}"] - 1) < 1e-9


def test_no_nulls_after_imputation(spark):
    from ontime.plans.registry import fl
    from ontime.operators.cleaning import cast_columns

    cols = ["DepTime", "DepDelay", "ArrTime"]
    df = cast_columns(fl(spark, SF), {c: "double" for c in cols})
    assert df.filter(F.col("DepTime").isNull()).count() > 0
    imp = M.impute_mean(df, cols)
    assert imp.df.filter(" OR ".join(f"{c} IS NULL" for c in cols)).count() == 0


def test_correlation_symmetric_unit_diagonal(spark):
    cols = ["DepDelay", "ArrDelay", "Distance", "TaxiOut"]
    got = {(r["col_x"], r["col_y"]): r["r"] for r in P.correlation_matrix(features(spark, SF), cols).collect()}
    for a in cols:
        assert got[(a, a)] == pytest.approx(1.0, abs=1e-12)
        for b in cols:
            assert got[(a, b)] == pytest.approx(got[(b, a)], abs=1e-15)
            assert -1.0 - 1e-12 <= got[(a, b)] <= 1.0 + 1e-12
    pdf = features(spark, SF).select(*cols).dropna().toPandas()
    assert got[("DepDelay", "ArrDelay")] == pytest.approx(pdf["DepDelay"].corr(pdf["ArrDelay"]), abs=1e-12)


def test_approx_quantile_rank_error(spark):
    df = features(spark, SF).select("ArrDelay")
    xs = sorted(r[0] for r in df.collect())
    n, err = len(xs), 0.01
    got = Q.quantiles_approx(df, ["ArrDelay"], [0.1, 0.5, 0.9], relative_error=err).collect()
    for r in got:
        lo = sum(1 for x in xs if x < r["value"])
        hi = sum(1 for x in xs if x <= r["value"])
        target = r["probability"] * n
        assert lo - err * n - 1 <= target <= hi + err * n + 1
