"""Stored quantile sketches: merged, repeated loads, awkward values, plans."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.operators import sketches as K
from ontime.operators.profile import numeric_summary, tidy_profile
from ontime.plans.inspect import physical_section


@pytest.fixture(scope="module")
def rows(spark):
    # One month holds half of the rows; values are skewed.
    return spark.range(40_000, numPartitions=6).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise((F.col("id") % 12 + 1).cast("int")).alias("month"),
        F.pow((F.xxhash64("id") % 1000) / F.lit(100.0), F.lit(3.0)).alias("v"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("double")).alias("w"))


def test_merged_months_are_within_the_stated_error(spark, rows, tmp_dir):
    K.store_sketches(rows.filter("month <= 6"), ["v", "w"], ["month"], tmp_dir + "/s", "a")
    K.store_sketches(rows.filter("month > 6"), ["v", "w"], ["month"], tmp_dir + "/s", "b")
    stored = K.read_sketches(spark, tmp_dir + "/s")
    part = rows.filter("month IN (1, 3, 8)")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = K.merged_quantiles(stored.filter("month IN (1, 3, 8)"), probs)
    assert "Scan parquet" in physical_section(found) or "FileScan parquet" in physical_section(found)
    checked = K.ranks_within(part, found, K.rank_error()).collect()
    assert len(checked) == 14 and all(r["within"] for r in checked)
    x = np.array([r["w"] for r in part.filter("w IS NOT NULL").collect()])
    got = {(r["column"], r["probability"]): (r["value"], r["n"]) for r in found.collect()}
    assert got["w", 0.0] == (x.min(), len(x)) and got["w", 1.0] == (x.max(), len(x))
    share = {r["value"]: r["share"] for r in K.merged_ranks(stored.filter("column = 'w'"), [10_000.0, 30_000.0]).collect()}
    whole = np.array([r["w"] for r in rows.filter("w IS NOT NULL").collect()])
    assert all(abs(s - (whole <= v).mean()) <= K.rank_error() for v, s in share.items())


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([(k % 3, float(k)) for k in range(300)], "g int, v double")
    got = {r["g"]: r["value"] for r in K.merged_quantiles(K.build_sketches(df, ["v"], ["g"]), [0.5], ["g"]).collect()}
    assert got == {g: sorted(float(k) for k in range(300) if k % 3 == g)[49] for g in range(3)}


def test_a_repeated_load_counts_once(spark, rows, tmp_dir):
    for _ in range(3):
        K.store_sketches(rows, ["v"], ["month"], tmp_dir + "/s", "all")
    stored = K.read_sketches(spark, tmp_dir + "/s")
    assert K.merged_quantiles(stored, [0.5]).first()["n"] == 40_000
    assert stored.agg(F.max(F.length("sketch"))).first()[0] < 16 * K.DEFAULT_K * 2


def test_summary_and_profile_of_merged_groups_are_those_of_the_rows(spark, rows):
    far = rows.withColumn("v", F.col("v") + 1e9)
    stored = K.build_sketches(far, ["v", "w"], ["month"])
    got = {r["column"]: r for r in K.merged_summary(stored).collect()}
    want = {r["column"]: r for r in numeric_summary(far, ["v", "w"]).collect()}
    for c in ("v", "w"):
        assert tuple(got[c]) == (c, want[c]["count"], pytest.approx(want[c]["mean"]), pytest.approx(want[c]["stddev"], rel=1e-6),
                                 want[c]["min"], want[c]["max"])
    tidy = {r["metric"]: r["value"] for r in K.merged_profile(stored, "w").collect()}
    exact = {r["metric"]: r["value"] for r in tidy_profile(rows, "w").collect()}
    assert list(tidy) == list(exact)
    assert all(tidy[m] == pytest.approx(exact[m], abs=2 * K.rank_error() * 40_000) for m in exact)
    one = K.merged_summary(K.build_sketches(spark.createDataFrame([(1, 5.0)], "g int, v double"), ["v"], ["g"])).first()
    assert one["stddev"] is None and one["mean"] == 5.0


def test_missing_values_null_groups_and_clashing_names(spark):
    df = spark.createDataFrame([(None, 1.0, 5.0), (None, math.nan, 5.0), (1, None, None), (1, math.inf, 2.0)],
                               "column int, n double, v double")
    got = {(r["column"], r["n"]) for r in K.build_sketches(df.withColumnRenamed("column", "g"), ["n", "v"], ["g"])
           .select("column", "n").collect()}
    assert got == {("n", 1), ("v", 2), ("v", 1)}
    assert K.merged_quantiles(K.build_sketches(df.limit(0), ["v"], []), [0.5]).count() == 0


def test_larger_sketches_state_smaller_errors():
    assert K.rank_error(4096) < K.rank_error(1024) < 0.01
