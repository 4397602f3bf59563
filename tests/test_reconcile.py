"""Files whose types disagree: groups by footer, the type lattice, declared tables, awkward layouts."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.sources import catalog as C
from ontime.sources import reconcile as R


@pytest.mark.parametrize(("types", "want"), [
    (["int", "bigint"], "bigint"), (["tinyint", "smallint"], "smallint"), (["int", "double"], "double"),
    (["float", "bigint"], "double"), (["decimal(10,2)", "int"], "decimal(12,2)"), (["decimal(38,2)", "bigint"], "decimal(38,2)"),
    (["decimal(38,0)", "decimal(10,5)"], "double"), (["date", "timestamp"], "timestamp"), (["int", "string"], "string"),
    (["boolean", "int"], "string"), (["void", "int"], "int"), (["int"], "int"), (["array<int>", "int"], "string")])
def test_lattice(spark, types, want):
    kinds = [T.NullType() if t == "void" else T.StructType.fromDDL(f"c {t}")["c"].dataType for t in types]
    assert R.common_type(kinds).simpleString() == want
    assert R.common_type(kinds[::-1]).simpleString() == want


def test_mixed_folder_and_many_files(spark, tmp_dir):
    at = tmp_dir + "/it's"
    spark.range(20).selectExpr("id", "cast(id as int) a").repartition(5).write.parquet(at + "/m=1")
    spark.range(20, 30).selectExpr("id", "concat('t', id) a", "id * 2 b").write.mode("append").parquet(at + "/m=1")
    spark.range(30, 40).selectExpr("id", "cast(id as int) a").write.parquet(at + "/m=2")
    groups = R.schema_groups(spark, at)
    assert len(groups) == 2 and sum(g.files for g in groups) == len([f for g in groups for f in spark.read.parquet(*g.paths).inputFiles()])
    rows = {r["id"]: (r["a"], r["b"], r["m"]) for r in R.reconciled_scan(spark, at, groups=groups).collect()}
    assert len(rows) == 40 and rows[3] == ("3", None, 1) and rows[25] == ("t25", 50, 1) and rows[35] == ("35", None, 2)
    asked = {r["id"]: r["a"] for r in R.reconciled_scan(spark, at, {"a": T.IntegerType()}).collect()}
    assert asked[3] == 3 and asked[25] is None
    report = {tuple(r)[:2] + (r["target"],) for r in R.conflict_report(groups, spark).collect()}
    assert report == {("a", "int", "string"), ("a", "string", "string")}


def test_one_schema_is_one_scan_and_nothing_is_an_error(spark, tmp_dir):
    spark.range(5).write.parquet(tmp_dir + "/t")
    df = R.reconciled_scan(spark, tmp_dir + "/t")
    assert df.count() == 5 and R.conflict_report(R.schema_groups(spark, tmp_dir + "/t"), spark).count() == 0
    with pytest.raises(FileNotFoundError):
        spark.range(0).write.csv(tmp_dir + "/none")
        R.reconciled_scan(spark, tmp_dir + "/none")


def test_declared_table_with_odd_names(spark, tmp_dir):
    at = tmp_dir + "/a 'quoted' folder"
    df = spark.range(4).select(F.col("id").alias("odd`name"), F.lit(date(2020, 1, 1)).alias("day"),
                               F.lit(1.5).cast("decimal(10,3)").alias("amount"), (F.col("id") % 2).cast("int").alias("part"))
    df.write.partitionBy("part").parquet(at)
    out = C.declare_table(spark, "declared_odd", at, df.schema, ["part"])
    assert out.count() == 4 and dict(out.dtypes) == dict(df.dtypes)
    assert C.register_external(spark, "registered_odd", at).count() == 4
    C.drop_table(spark, "declared_odd")
    C.drop_table(spark, "registered_odd")
