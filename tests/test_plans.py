"""Plan tests: one scan per report, pushdown and pruning reach the Parquet reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from ontime.operators import cleaning as C
from ontime.operators import ml as M
from ontime.operators import profile as P
from ontime.operators import quantiles as Q
from ontime.operators import rates as R
from ontime.plans import inspect as I
from ontime.plans.registry import clean, features, fl, raw_features
from ontime.session import scratch_path
from ontime.sources.files import read_parquet
from ontime.sources.sinks import write_layer

SF = "/root/testdata/sf0.001"


def test_single_scan_reports(spark):
    assert I.file_scans(P.missing_report(raw_features(spark, SF))) == 1
    assert I.file_scans(R.bucket_summary(clean(spark, SF))) == 1
    assert I.file_scans(C.cleaning_report(fl(spark, SF))) == 1
    assert I.file_scans(R.rate_grouping_sets(clean(spark, SF), ["Month", "DayOfWeek"])) == 1


def test_source_scans_of_stage_five(spark):
    """The plotted columns' histogram and density come from one scan of value counts, scaling from two."""
    vc = Q.value_counts(features(spark, SF), ["ArrDelay"])
    assert I.file_scans(vc) == 1
    assert I.file_scans(M.impute_mean(features(spark, SF), ["DepTime"]).df) == 1


def test_column_pruning_to_scan(spark):
    df = R.bucket_summary(clean(spark, SF))
    schemas = I.read_schemas(df)
    assert len(schemas) == 1
    # Only the columns the flight projection needs for ArrDelay.
    assert "l_extendedprice" not in schemas[0] and "l_returnflag" not in schemas[0]


def test_typed_layer_filters_reach_parquet(spark):
    path = scratch_path(spark, "plan-layer")
    write_layer(features(spark, SF), path, ["Year", "Month"])
    layer = read_parquet(spark, path)
    q = C.not_cancelled(layer).filter(F.col("ArrDelay") >= 15).select("ArrDelay")
    pushed = " ".join(I.pushed_filters(q))
    assert "Cancelled" in pushed and "ArrDelay" in pushed
    pruned = layer.filter(F.col("Month") == 6).groupBy("Year").count()
    assert any("Month" in p for p in I.partition_filters(pruned))


def test_whole_stage_codegen_for_rates(spark):
    df = R.rate_by(clean(spark, SF), ["Month"])
    df.collect()  # AQE inserts codegen stages in the final plan
    assert I.whole_stage_spans(df) >= 1


def test_top_k_is_take_ordered(spark):
    plan = I.physical_section(R.top_by_rate(clean(spark, SF), "Month", 6))
    assert "TakeOrderedAndProject" in plan


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A key holding a third of the rows: every grouped report aggregates map-side first."""
    rows = [(1, 1.0)] * 300 + [(k % 12 + 2, float(k % 40)) for k in range(600)]
    df = spark.createDataFrame(rows, "Month int, ArrDelay double")
    for q in (R.rate_by(df, ["Month"]), R.bucket_summary(df), P.missing_report(df),
              R.rate_grouping_sets(df, ["Month"])):
        plan = I.physical_section(q)
        assert "partial_" in plan, plan
    got = {r["Month"]: r["n"] for r in R.rate_by(df, ["Month"]).collect()}
    assert got[1] == 300 + sum(1 for k in range(600) if k % 12 + 2 == 1)
