"""Inline edge rows (FIXTURES F6) and degenerate inputs."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ontime.functions import delay_bucket, delayed_flag, hhmm_hour
from ontime.operators import cleaning as C
from ontime.operators import ml as M
from ontime.operators import profile as P
from ontime.operators import quantiles as Q
from ontime.operators import rates as R

EDGE_ROWS = [
    # ArrDelay, DepTime, Year, expected bucket, expected hour, delayed
    ("-15", "745", 2006, "<= -15", 7, 0),
    ("0", "5", 2006, "(-15,0]", 0, 0),
    ("14.999", "59", 2006, "(0,15)", 0, 0),
    ("15", "2400", 2006, ">= 15", 24, 1),
    ("NA", "NA", 2006, None, None, None),
    ("NaN", "1200", 2006, None, 12, None),
    ("", "", 2006, None, None, None),
    ("3", "900", None, "(0,15)", 9, 0),
]


@pytest.fixture()
def edge(spark):
    rows = [(a, d, y, 1) for a, d, y, *_ in EDGE_ROWS]
    return spark.createDataFrame(rows, "ArrDelay string, DepTime string, Year int, Month int")


def test_clean_target_drops_na_nan_empty(edge):
    out = C.clean_target(edge)
    assert out.schema["ArrDelay"].dataType.simpleString() == "double"
    assert sorted(r["ArrDelay"] for r in out.collect()) == [-15.0, 0.0, 3.0, 14.999, 15.0]


def test_cleaning_report_counts(edge):
    r = C.cleaning_report(edge).first()
    assert (r["rows_before"], r["rows_after"], r["rows_removed"]) == (8, 5, 3)


def test_buckets_flags_hours(edge):
    clean = C.cast_columns(C.clean_target(edge), {"DepTime": "int"})
    rows = clean.select("ArrDelay", delay_bucket("ArrDelay").alias("b"), delayed_flag("ArrDelay").alias("f"),
                        hhmm_hour("DepTime").alias("h")).collect()
    expect = {float(a): (b, f, h) for a, _, _, b, h, f in EDGE_ROWS if b is not None}
    for r in rows:
        assert (r["b"], r["f"], r["h"]) == expect[r["ArrDelay"]]


def test_hhmm_hour_and_wrap(spark):
    df = spark.createDataFrame([(745,), (5,), (2400,), (None,)], "t int")
    got = df.select(hhmm_hour("t").alias("h"), hhmm_hour("t", wrap24=True).alias("w")).collect()
    assert [(r["h"], r["w"]) for r in got] == [(7, 7), (0, 0), (24, 0), (None, None)]


def test_unknown_bucket_for_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (20.0,)], "ArrDelay double")
    got = {r["delay_bucket"]: r["n"] for r in R.bucket_summary(df).collect()}
    assert got == {"unknown": 2, ">= 15": 1}
    legacy = {r["delay_bucket"]: r["n"] for r in R.bucket_summary(df, unknown_bucket=False).collect()}
    assert legacy == {">= 15": 3}


def test_dropna_year_month(edge):
    assert C.dropna_subset(edge, ["Year", "Month"]).count() == 7


def test_empty_input_percentages_are_null(spark):
    empty = spark.createDataFrame([], "ArrDelay double, Month int")
    r = R.delay_rate_overall(empty).first()
    assert r["total"] == 0 and r["pct_delayed"] is None
    assert R.bucket_summary(empty).count() == 0
    rep = P.missing_report(empty).collect()
    assert all(x["pct_missing"] is None for x in rep)


def test_one_row_stddev_null(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    r = P.numeric_summary(one, ["x"]).first()
    assert r["count"] == 1 and r["stddev"] is None


def test_constant_column_correlation_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    got = {(r["col_x"], r["col_y"]): r["r"] for r in P.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("a", "a")] is None
    assert got[("b", "b")] == pytest.approx(1.0)


def test_all_null_column_reported_not_imputed(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, 4.0)], "a double, b double, ArrDelay double")
    imp = M.impute_mean(df, ["a", "b", "ArrDelay"])
    assert imp.dropped_all_null == ["b"]
    assert imp.imputed == ["a"]
    assert [r["a"] for r in imp.df.collect()] == [1.0, 1.0]


def test_label_not_imputed_unless_compat(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 4.0)], "a double, ArrDelay double")
    assert M.impute_mean(df, ["a", "ArrDelay"]).df.filter(F.col("ArrDelay").isNull()).count() == 1
    compat = M.impute_mean(df, ["a", "ArrDelay"], reference_compat=True).df
    assert compat.filter(F.col("ArrDelay").isNull()).count() == 0


def test_aliases_and_missing_wanted(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Canceled int, DayOfMonth int, Year int")
    sel = C.typed_features(df)
    assert set(sel.present) == {"Cancelled", "DayofMonth", "Year"}
    assert "ArrDelay" in sel.missing and "Canceled" not in sel.df.columns


def test_missing_report_type_dispatch(spark):
    df = spark.createDataFrame([(None, float("nan"), ""), (1, 2.0, "x")], "i int, d double, s string")
    got = {r["column"]: (r["n_missing"], r["pct_missing"]) for r in P.missing_report(df).collect()}
    assert got == {"i": (1, 50.0), "d": (1, 50.0), "s": (1, 50.0)}
    tokens = {r["column"]: r["n_missing"] for r in P.missing_report(
        spark.createDataFrame([("NA",), ("x",)], "s string"), na_tokens=("NA",)).collect()}
    assert tokens == {"s": 1}


def test_quantiles_ignore_null_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (2.0,)], "x double")
    got = {r["probability"]: r["value"] for r in Q.quantiles_disc(df, ["x"], [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 1.0, 0.5: 2.0, 1.0: 3.0}


def test_histogram_upper_bound_in_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    h = {r["bin"]: r["n"] for r in P.histogram(df, "x", bins=10).collect()}
    assert sum(h.values()) == 11 and h[10] == 2 and max(h) == 10


def test_kde_integrates_to_one(spark):
    df = spark.createDataFrame([(float(i % 7),) for i in range(200)], "x double")
    k = P.kde_grid(df, "x", gridsize=400).collect()
    step = k[1]["x"] - k[0]["x"]
    assert sum(r["density"] for r in k) * step == pytest.approx(1.0, abs=0.01)


def test_pct_rounding_and_try_divide(spark):
    df = spark.createDataFrame([(1, 3)], "a int, b int")
    from ontime.functions import pct

    assert df.select(pct(F.col("a"), F.col("b")).alias("p")).first()["p"] == 33.333
    zero = spark.createDataFrame([(1, 0)], "a int, b int")
    assert zero.select(pct(F.col("a"), F.col("b")).alias("p")).first()["p"] is None


def test_numeric_summary_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = P.numeric_summary(df, ["x"]).first()
    assert r["count"] == 2 and r["mean"] == 2.0 and not math.isnan(r["max"])


def test_first_k_features_and_schema_frame(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3, 4.0)], "a int, b double, s string, c int, ArrDelay double")
    assert C.first_k_features(df, k=2) == ["a", "b"]
    assert C.first_k_features(df, k=8) == ["a", "b", "c"]
    sch = {r["column"]: r["type"] for r in C.describe_schema(df).collect()}
    assert sch == {"a": "int", "b": "double", "s": "string", "c": "int", "ArrDelay": "double"}
    assert C.numeric_columns(df, wanted=["s", "b", "zz"]) == ["b"]


def test_correlation_degenerate_inputs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (4.0, 9.0, 5.0), (3.0, None, 5.0)],
                               "a double, b double, c double")
    got = {(r["col_x"], r["col_y"]): r["r"] for r in P.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = df.dropna().select(F.corr("a", "b")).first()[0]
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(want, abs=1e-12)
    assert got[("a", "a")] == pytest.approx(1.0) and got[("a", "c")] is None and got[("c", "c")] is None
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    for frame in (one, one.limit(0)):
        assert all(r["r"] is None for r in P.correlation_matrix(frame, ["a", "b"]).collect())


def test_correlation_of_many_columns_is_quick(spark):
    import time

    k = 100
    rows = [tuple(float((i * (j + 3)) % (7 + j % 5)) for j in range(k)) for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(k)))
    start = time.monotonic()
    assert P.correlation_matrix(df, df.columns).count() == k * k
    assert time.monotonic() - start < 60


def test_correlation_pairwise_uses_each_pairs_rows(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 4.0), (4.0, 9.0, 1.0), (3.0, None, 2.0), (None, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    for r in P.correlation_pairwise(df, ["a", "b", "c"]).collect():
        pair = df.select(r["col_x"], r["col_y"]).dropna()
        want = pair.select(F.corr(r["col_x"], r["col_y"])).first()[0]
        assert r["n"] == pair.count() and r["r"] == pytest.approx(want, abs=1e-12)


INF = float("inf")


def test_infinities_are_values_of_quantiles_and_outside_histograms(spark):
    df = spark.createDataFrame([(-INF,), (1.0,), (2.0,), (3.0,), (INF,), (INF,)], "x double")
    got = {r["probability"]: r["value"] for r in Q.quantiles_disc(df, ["x"], [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: -INF, 0.5: 2.0, 1.0: INF}
    assert P.describe_columns(df, ["x"]).first()["max"] == INF
    assert sum(r["n"] for r in P.histogram(df, "x", bins=4).collect()) == 3
    only = spark.createDataFrame([(INF,), (INF,)], "x double")
    assert Q.quantiles_disc(only, ["x"], [0.5]).first()["value"] == INF
    assert P.histogram(only, "x").count() == 0 and P.kde_grid(only, "x").count() == 0


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    rows = P.histogram(df, "x", bins=80).collect()
    assert [r["bin"] for r in rows] == list(range(1, 81))
    assert [r["n"] for r in rows] == [1] + [0] * 78 + [1]


def test_crowded_bucket_is_split_until_it_fits_the_row_budget(spark, monkeypatch):
    """One million distinct doubles, a small budget: no window partition above it."""
    df = spark.range(1_000_000).select((F.col("id").cast("double") ** 1.5 + 0.25).alias("x"))
    widest = []
    plain = Q._rank_plan

    def watched(vcb, hits, targets):
        widest.append(hits.agg(F.max("values")).first()[0])
        return plain(vcb, hits, targets)

    monkeypatch.setattr(Q, "_rank_plan", watched)
    got = {r["probability"]: r["value"] for r in
           Q.quantiles_disc(df, ["x"], [0.1, 0.5, 0.999], buckets=8, row_budget=500).collect()}
    assert got == {p: float(round(p * 1_000_000) - 1) ** 1.5 + 0.25 for p in (0.1, 0.5, 0.999)}
    assert widest[0] <= 500


def test_decimal_text_is_cut_to_integers(spark):
    rows = [("745.0",), ("745.9",), ("-3.7",), ("NA",), ("NaN",), ("99999999999",), ("12",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r["t"] for r in C.cast_columns(df, {"t": "int"}).collect()]
    assert got == [745, 745, -3, None, None, None, 12, None]
    big = spark.createDataFrame([("9007199254740993",), ("5.5",)], "t string")
    assert [r["t"] for r in C.cast_columns(big, {"t": "bigint"}).collect()] == [9007199254740993, 5]


def test_enrich_joins_one_dimension_row_and_forces_no_broadcast(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, f string")
    dim = spark.createDataFrame([(1, "x" * 5000), (1, "y"), (2, "z")], "k int, d string")
    out = R.enrich(fact, dim, "k")
    assert sorted((r["k"], r["d"][:1] if r["d"] else None) for r in out.collect()) == [(1, "x"), (2, "z"), (3, None)]
    wide = spark.range(10).select(F.col("id").cast("int").alias("k"), F.repeat(F.lit("w"), 100_000).alias("d"))
    plan = R.enrich(fact, wide, "k")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_kde_binned_close_to_exact(spark):
    df = spark.createDataFrame([(float(i) * 0.37 % 11.0,) for i in range(500)], "x double")
    exact = [r["density"] for r in P.kde_grid(df, "x", gridsize=50).collect()]
    binned = [r["density"] for r in P.kde_grid(df, "x", gridsize=50, bins=2000).collect()]
    assert max(abs(a - b) for a, b in zip(exact, binned)) < 1e-3 * max(exact)
