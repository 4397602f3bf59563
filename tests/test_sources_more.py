"""Checked CSV, partition differences and bucketed tables."""

from __future__ import annotations

import os
import shutil

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.plans.inspect import physical_section
from ontime.plans.registry import clean, q_bucketed_counts, q_bucketed_join
from ontime.sources import catalog as C
from ontime.sources.rejects import ingest_csv, read_csv_checked

SCHEMA = T.StructType([T.StructField("k", T.IntegerType(), False), T.StructField("v", T.DoubleType()), T.StructField("t", T.StringType())])
GOOD = ["1,2.5,abc", "2,NA,x", "3.0,1e3,\"quoted, comma\"", "4,,", " 5 ,7,plain"]
BAD = {"x,1,a": ["k: x"], "6,wide,b": ["v: wide"], "7,1": ["fields"], "8,1,c,extra": ["fields"], "NA,1,d": ["required: k"],
       "y,z,e": ["k: y", "v: z"], "99999999999,1,f": ["k: 99999999999"], "no separators": ["fields"]}


@pytest.fixture()
def damaged(tmp_dir):
    os.makedirs(tmp_dir + "/in")
    for n, lines in enumerate([["k,v,t", *GOOD, ""], ["k,v,t", *BAD, "   "]]):
        with open(f"{tmp_dir}/in/part{n}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    return tmp_dir + "/in"


def test_every_line_is_accepted_or_rejected(spark, damaged, tmp_dir):
    got = ingest_csv(spark, damaged, tmp_dir + "/out", SCHEMA)
    rejected = {r["line"]: r["reasons"] for r in got.rejected.collect()}
    assert rejected == BAD
    rows = {r["k"]: (r["v"], r["t"]) for r in got.accepted.collect()}
    assert rows == {1: (2.5, "abc"), 2: (None, "x"), 3: (1000.0, "quoted, comma"), 4: (None, None), 5: (7.0, "plain")}
    assert {os.path.basename(r["file"]) for r in got.rejected.collect()} == {"part1.csv"}
    assert got.accepted.schema.fieldNames() == SCHEMA.fieldNames()


def test_lenient_columns_and_taken_names(spark, damaged):
    lines = read_csv_checked(spark, damaged, SCHEMA, lenient=("v",))
    kept = {r["k"] for r in lines.filter(F.size("_reasons") == 0).collect()}
    assert kept == {1, 2, 3, 4, 5, 6}
    with pytest.raises(ValueError):
        read_csv_checked(spark, damaged, T.StructType([T.StructField("_line", T.StringType())]))


def test_the_csv_is_read_once(spark, damaged):
    assert physical_section(read_csv_checked(spark, damaged, SCHEMA)).count("FileScan text") == 1


def test_partitions_in_step(spark, tmp_dir, monkeypatch):
    at = tmp_dir + "/layer"
    df = spark.createDataFrame([(1, "a b"), (2, "c=d"), (3, None), (4, "e'f")], "v int, part string")
    df.write.partitionBy("part").parquet(at)
    table = C.register_external(spark, "in_step", at)
    assert table.count() == 4 and C.partition_diff(spark, "in_step").count() == 0
    monkeypatch.setattr(C, "recover_partitions", lambda *a: pytest.fail("a full repair"))
    gone = next(f for f in os.listdir(at) if f.startswith("part=a"))
    shutil.rmtree(f"{at}/{gone}")
    spark.createDataFrame([(5, "new/one"), (6, "new/one")], "v int, part string").write.mode("append").partitionBy("part").parquet(at)
    changes = {r["change"]: r["partition"] for r in C.sync_partitions(spark, "in_step").collect()}
    assert set(changes) == {"add", "drop"} and changes["drop"] == gone
    assert {(r["v"], r["part"]) for r in spark.table("in_step").collect()} == {
        (2, "c=d"), (3, None), (4, "e'f"), (5, "new/one"), (6, "new/one")}
    assert C.sync_partitions(spark, "in_step").count() == 0
    C.drop_table(spark, "in_step")


def test_unpartitioned_table_has_no_difference(spark, tmp_dir):
    spark.range(3).write.parquet(tmp_dir + "/flat")
    C.register_external(spark, "flat_in_step", tmp_dir + "/flat")
    assert C.sync_partitions(spark, "flat_in_step").count() == 0
    C.drop_table(spark, "flat_in_step")


def test_bucketed_tables_need_no_shuffle_on_their_key(spark):
    assert "hashpartitioning(Origin" not in physical_section(q_bucketed_counts(spark, SF_SMALL))
    plan = physical_section(q_bucketed_join(spark, SF_SMALL))
    assert "SortMergeJoin" in plan and "hashpartitioning(l_orderkey" not in plan and "hashpartitioning(o_orderkey" not in plan


def test_a_hot_bucket_keeps_all_rows(spark, tmp_dir):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("x").alias("pad"))
    table = C.save_bucketed(df.union(spark.createDataFrame([(None, "null key")], "k bigint, pad string")), "hot_bucket",
                            tmp_dir + "/hot", ["k"], 4)
    assert table.count() == 20_001 and table.filter("k = 7").count() == df.filter("k = 7").count()
    assert table.filter("k IS NULL").count() == 1
    assert clean(spark, SF_SMALL).count()  # the session still reads other tables
    C.drop_table(spark, "hot_bucket")
