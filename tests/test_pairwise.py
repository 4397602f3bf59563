"""Correlations over gaps by masked products: against pandas, wide tables, awkward values."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.operators.profile import correlation_pairwise


def test_equals_pandas_on_gaps_and_large_means(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 6)) @ rng.normal(size=(6, 6)) + [1e6, -1e6, 0, 5, 1e3, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    import pandas as pd

    pdf = pd.DataFrame(x, columns=list("abcdef"))
    df = spark.createDataFrame([tuple(None if math.isnan(v) and k % 2 else float(v) for v in row) for k, row in enumerate(x)],
                               ", ".join(f"{c} double" for c in "abcdef")).repartition(5)
    want = pdf.corr()
    for r in correlation_pairwise(df, list("abcdef")).collect():
        both = pdf[[r["col_x"], r["col_y"]]].dropna()
        assert r["n"] == len(both) and r["r"] == pytest.approx(want.loc[r["col_x"], r["col_y"]], abs=1e-9)


def test_awkward_columns(spark):
    rows = [(1.0, 2.0, 7.0, None, 1.0), (2.0, 4.0, 7.0, None, math.inf), (3.0, 6.0, 7.0, None, 2.0), (None, 1.0, 7.0, None, 3.0),
            (math.nan, 1.0, 7.0, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, flat double, none double, inf double")
    got = {(r["col_x"], r["col_y"]): (r["n"], r["r"]) for r in correlation_pairwise(df, df.columns).collect()}
    assert got["a", "b"] == (3, pytest.approx(1.0)) and got["a", "flat"] == (3, None) and got["a", "none"] == (0, None)
    assert got["a", "inf"] == (3, None) and got["b", "flat"] == (5, None) and len(got) == 10
    assert {tuple(r)[2:] for r in correlation_pairwise(df.limit(0), ["a", "b"]).collect()} == {(0, None)}
    assert correlation_pairwise(df, ["a"]).count() == 0


def test_two_hundred_columns(spark):
    df = spark.range(500).select(*[F.when(F.rand(i) < 0.9, F.randn(i + 1000)).alias(f"c{i}") for i in range(200)])
    start = time.time()
    out = correlation_pairwise(df, df.columns)
    rows = out.collect()
    assert time.time() - start < 60 and len(rows) == 200 * 199 // 2 and all(abs(r["r"]) < 0.4 for r in rows)
