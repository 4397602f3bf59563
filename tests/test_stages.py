"""The reference's stages as functions: feature and transformed layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ontime.plans.registry import clean, fl
from ontime.plans.stages import feature_layer, transformed_layer
from ontime.schema import FEATURE_COLUMNS, transformed_types
from ontime.session import get_spark

SF = "/root/testdata/sf0.001"


def test_get_spark_reuses_active_session(spark):
    assert get_spark() is spark


def test_feature_layer_schema(spark):
    sel = feature_layer(clean(spark, SF))
    assert sel.df.columns == FEATURE_COLUMNS and sel.missing == []
    assert dict(sel.df.dtypes)["ArrDelay"] == "double" and dict(sel.df.dtypes)["DepTime"] == "int"


def test_transformed_layer_types_and_hours(spark):
    t = transformed_layer(feature_layer(clean(spark, SF)).df)
    types = dict(t.df.dtypes)
    for c, ty in transformed_types().items():
        assert types[c] == ty, c
    bad = t.df.filter((F.col("DepHour") != (F.col("DepTime") / 100).cast("int")))
    assert bad.count() == 0


def test_transformed_layer_imputes_without_label(spark):
    raw = feature_layer(fl(spark, SF)).df  # not target-cleaned: ArrDelay has nulls
    t = transformed_layer(raw, impute=True)
    assert "ArrDelay" not in t.imputed and "DepTime" in t.imputed
    assert t.df.filter("DepTime IS NULL").count() == 0
    assert t.df.filter("ArrDelay IS NULL").count() > 0
    compat = transformed_layer(raw, impute=True, reference_compat=True)
    assert compat.df.filter("ArrDelay IS NULL").count() == 0
