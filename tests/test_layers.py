"""Layer tests: write, register, recover, read back, fallback order."""

from __future__ import annotations

import os

import pytest

from ontime.plans.registry import features, fl
from ontime.plans.stages import etl_csv_to_parquet, load_and_clean, register_layer
from ontime.session import is_local, scratch_path, shared_dir
from ontime.sources import catalog as K
from ontime.sources.files import path_exists, read_csv_raw, read_csv_typed, read_parquet
from ontime.sources.sinks import cut_lineage, persisted, write_layer

SF = "/root/testdata/sf0.001"


def test_shared_dir_is_session_checkpoint_dir(spark):
    d = shared_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d
    assert scratch_path(spark, "x").startswith(d)


def test_partitioned_write_register_recover(spark):
    df = features(spark, SF)
    path = scratch_path(spark, "layer-p")
    keys = write_layer(df, path, ["Year", "Month"])
    assert keys == ["Year", "Month"]
    t = K.register_external(spark, "test_layer_p", path)
    assert K.partition_columns(spark, "test_layer_p") == ["Year", "Month"]
    assert t.count() == df.count()
    # re-registering replaces metadata instead of keeping the old table
    t2 = K.register_external(spark, "test_layer_p", path)
    assert t2.count() == df.count()


def test_flat_write_register_no_repair(spark):
    df = features(spark, SF)
    path = scratch_path(spark, "layer-f")
    assert write_layer(df, path) == []
    K.register_external(spark, "test_layer_f", path)
    assert K.recover_partitions(spark, "test_layer_f") is False
    assert K.scan_table(spark, "test_layer_f").count() == df.count()
    assert K.scan_table(spark, "test_layer_f", limit=5).count() == 5


def test_partition_keys_only_if_present(spark):
    df = features(spark, SF).drop("Month")
    path = scratch_path(spark, "layer-s11")
    assert write_layer(df, path, ["Year", "Month"]) == ["Year"]
    with pytest.raises(ValueError):
        write_layer(df, scratch_path(spark, "x"), ["Year", "Month"], require_partition_columns=True)


def test_save_as_table_and_listing(spark):
    df = features(spark, SF)
    t = K.save_as_table(df, "test_saved", scratch_path(spark, "saved"), ["Year"])
    assert t.count() == df.count()
    names = [r["name"] for r in K.list_tables(spark, "default").collect()]
    assert "test_saved" in names and K.table_exists(spark, "test_saved")
    assert "default" in K.list_databases(spark)
    K.drop_table(spark, "test_saved")
    assert not K.table_exists(spark, "test_saved")


def test_overwrite_replaces_the_whole_layer(spark):
    df = features(spark, SF)
    path = scratch_path(spark, "over")
    write_layer(df, path)  # flat first, partitioned over it
    write_layer(df, path, ["Year", "Month"])
    assert read_parquet(spark, path).count() == df.count()
    write_layer(df.filter("Month = 6"), path, ["Year", "Month"])
    assert {r["Month"] for r in read_parquet(spark, path).select("Month").distinct().collect()} == {6}
    write_layer(df.filter("Month = 7"), path, ["Year", "Month"], only_partitions=True)
    assert {r["Month"] for r in read_parquet(spark, path).select("Month").distinct().collect()} == {6, 7}
    write_layer(df.limit(0), path)
    assert read_parquet(spark, path).count() == 0


def test_save_as_table_refuses_its_own_input(spark):
    path = scratch_path(spark, "own")
    write_layer(features(spark, SF), path)
    with pytest.raises(ValueError):
        K.save_as_table(read_parquet(spark, path), "test_own", path)


def test_load_first_returns_an_empty_table(spark):
    path = scratch_path(spark, "empty-p")
    write_layer(features(spark, SF).limit(0), path)
    K.register_external(spark, "test_empty", path)
    df, used = K.load_first(spark, [K.Candidate("table", "test_empty"), K.Candidate("parquet", f"{SF}/nation.parquet")])
    assert used.kind == "table" and df.count() == 0


def test_local_master_names():
    assert is_local("local") and is_local("local[8]")
    assert not is_local("local-cluster[3,2,1024]") and not is_local("yarn") and not is_local("spark://host:7077")


def test_decimal_integers_in_csv(spark):
    path = scratch_path(spark, "decimal")
    spark.createDataFrame([("745.0", "3.0"), ("NA", "4")], "DepTime string, Month string").write.option(
        "header", "true").csv(path)
    assert sorted((r["DepTime"] or 0, r["Month"]) for r in read_csv_typed(spark, path).collect()) == [(0, 4), (745, 3)]


def test_csv_raw_and_typed(spark):
    path = scratch_path(spark, "csv")
    fl(spark, SF).write.option("header", "true").csv(path)
    raw = read_csv_raw(spark, path)
    assert all(t == "string" for _, t in raw.dtypes)
    typed = read_csv_typed(spark, path)
    dt = dict(typed.dtypes)
    assert dt["ArrDelay"] == "double" and dt["DepTime"] == "int" and dt["UniqueCarrier"] == "string"
    assert typed.filter("DepTime IS NULL").count() == raw.filter("DepTime = 'NA'").count()
    inferred = read_csv_typed(spark, path, infer=True)
    assert inferred.count() == raw.count()


def test_path_exists(spark):
    assert path_exists(spark, f"{SF}/lineitem.parquet")
    assert not path_exists(spark, scratch_path(spark, "never-written"))


def test_load_first_order_and_errors(spark):
    missing = scratch_path(spark, "missing")
    df, used = K.load_first(spark, [K.Candidate("table", "default.nope"), K.Candidate("parquet", missing),
                                     K.Candidate("parquet", f"{SF}/nation.parquet")])
    assert used.kind == "parquet" and df.count() == 25
    with pytest.raises(FileNotFoundError):
        K.load_first(spark, [K.Candidate("parquet", missing)])


def test_load_first_prefers_table(spark):
    path = scratch_path(spark, "tbl")
    write_layer(features(spark, SF), path, ["Year", "Month"])
    register_layer(spark, "test_pref", path)
    df, used = K.load_first(spark, [K.Candidate("table", "test_pref"), K.Candidate("parquet", path)])
    assert used.kind == "table" and df.count() > 0


def test_etl_and_load_and_clean_from_csv(spark):
    csv = scratch_path(spark, "etl-csv")
    fl(spark, SF).write.option("header", "true").csv(csv)
    out = scratch_path(spark, "etl-out")
    assert etl_csv_to_parquet(spark, csv, out) == ["Year", "Month"]
    assert any(name.startswith("Year=") for name in os.listdir(out.removeprefix("file:")))
    clean, used = load_and_clean(spark, [K.Candidate("parquet", out)])
    assert used.kind == "parquet"
    assert clean.count() == read_parquet(spark, out).filter("ArrDelay IS NOT NULL").count()


def test_persisted_releases_and_checkpoint(spark):
    df = features(spark, SF)
    with persisted(df, materialize=True) as cached:
        assert cached.is_cached
    assert not df.is_cached
    cut = cut_lineage(df.select("ArrDelay"))
    assert cut.count() == df.count()


def test_merge_schema_reads_all_footers(spark):
    base = scratch_path(spark, "merge")
    features(spark, SF).select("Year", "ArrDelay").write.parquet(f"{base}/part=1")
    features(spark, SF).select("Year", "DepDelay").write.parquet(f"{base}/part=2")
    merged = read_parquet(spark, base, merge_schema=True)
    assert {"Year", "ArrDelay", "DepDelay", "part"} <= set(merged.columns)


def test_refresh_sees_new_files(spark):
    path = scratch_path(spark, "refresh")
    df = features(spark, SF)
    write_layer(df, path)
    t = K.register_external(spark, "test_refresh", path)
    n = t.count()
    df.write.mode("append").parquet(path)
    K.refresh(spark, "test_refresh")
    assert spark.table("test_refresh").count() == 2 * n
