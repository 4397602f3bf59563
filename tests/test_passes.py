"""What the model queries cost: methods small enough to be compiled, and one layout of a train set per query."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.operators import ml as M
from ontime.plans import registry as R

LINEITEM = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate date")


def lineitem(spark, folder, n=400):
    rows = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7 % 31).alias("l_partkey"), (F.col("id") % 13).alias("l_suppkey"),
        (F.col("id") % 5 + 1).cast("int").alias("l_linenumber"), (F.col("id") * 11 % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") * 17 % 9000 + 900).cast("double").alias("l_extendedprice"), (F.col("id") % 11 / 100).alias("l_discount"),
        (F.col("id") % 9 / 100).alias("l_tax"), F.lit("N").alias("l_returnflag"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("l_shipdate"))
    rows = rows.unionByName(rows.limit(20)).to(T._parse_datatype_string(LINEITEM))
    rows.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_flight_view_is_compiled_in_sessions_built_elsewhere(spark, tmp_path):
    d, name = lineitem(spark, tmp_path), "spark.sql.codegen.hugeMethodLimit"
    kept = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        R.fl(spark, d)
        assert int(spark.conf.get(name)) == 8000
        spark.conf.set(name, "4000")
        R.fl(spark, d)
        assert int(spark.conf.get(name)) == 4000
    finally:
        spark.conf.set(name, kept)


def test_a_query_lays_its_train_set_out_once(spark, tmp_path, monkeypatch):
    d, seen, laid_out = lineitem(spark, tmp_path), [], M.laid_out

    @contextmanager
    def counted(*given):
        seen.append(given)
        with laid_out(*given) as rows:
            yield rows

    monkeypatch.setattr(M, "laid_out", counted)
    for query, most in (("linear_regression", 1), ("model_comparison_exact", 1)):
        seen.clear()
        assert R.QUERIES[query](spark, d).count() and len(seen) == most


def test_random_halves_are_counted_with_their_copies(spark, tmp_path, monkeypatch):
    d = lineitem(spark, tmp_path)
    n = R.clean(spark, d).count()
    assert [tuple(r) for r in R.q_random_split_counts(spark, d).collect()] == [(n, 0, True)]
    real = R.S.random_split
    monkeypatch.setattr(R.S, "random_split", lambda df, *a, **k: [df.dropDuplicates(), real(df, *a, **k)[1].limit(0)])
    found = R.q_random_split_counts(spark, d).first()
    assert 0 < found["lost"] == n - found["total"] and not found["near"]


def test_passes_over_the_models_rows_do_not_run_the_view_again(spark, tmp_path):
    d = lineitem(spark, tmp_path)
    halves = R._train_test(spark, d)
    files = [f for half in halves for f in half.inputFiles()] + R.QUERIES["transform_impute_scale"](spark, d).inputFiles()
    assert files and not any("lineitem" in f for f in files)
    rows = R.C.not_cancelled(R.C.typed_features(R.clean(spark, d), keep_extra=R.KEYS).df)
    for half, plain in zip(halves, R.S.hash_split(rows, 0.2, R.KEYS), strict=True):
        keys = [*R.KEYS, "ArrDelay"]
        assert half.count() and sorted(half.select(*keys).collect()) == sorted(plain.select(*keys).collect())


def test_written_split_keeps_null_keys_columns_and_empty_halves(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b"), (3, None)], "k int, Split string")
    halves = R.S.hash_split_written(rows, 0.5, ["k"])
    plain = R.S.hash_split(rows, 0.5, ["k"])
    for half, other in zip(halves, plain, strict=True):
        assert half.columns == rows.columns
        assert sorted(map(str, half.collect())) == sorted(map(str, other.collect()))
    assert [h.count() for h in R.S.hash_split_written(rows.limit(0), 0.2, ["k"])] == [0, 0]


def test_correlation_reads_its_rows_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(100).selectExpr("id", "id * id AS b").mapInArrow(counted, "id long, b long")
    found = R.P.correlation_matrix(rows, ["id", "b"]).collect()
    assert len(found) == 4 and seen.value == 100


def test_layout_is_sorted_by_the_label(spark):
    rows = spark.range(200).selectExpr("id AS k", "CAST(id * 37 % 50 AS double) AS ArrDelay")
    with M.laid_out(rows, 4) as laid:
        parts = laid.rdd.glom().collect()
    assert sum(map(len, parts)) == 200
    assert all(list(p) == sorted(p, key=lambda r: (r["ArrDelay"], r["k"])) for p in parts)


def test_complete_rows_are_kept_after_the_split_is_written(spark, tmp_path, monkeypatch):
    """A filter ahead of the write is pushed below the casts, which then run twice."""
    d, given, real = lineitem(spark, tmp_path), [], R.S.hash_split_written
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    rows.limit(3).withColumn("l_tax", F.lit(None).cast("double")).write.mode("append").parquet(f"{d}/lineitem.parquet")
    monkeypatch.setattr(R.S, "hash_split_written", lambda df, *a: given.append(df) or real(df, *a))
    halves = R._train_test(spark, d)
    assert sum(h.count() for h in halves) == given[0].dropna().count() < given[0].count()
    assert "atleastnnonnulls" not in given[0]._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_split_is_written_without_a_sort(spark, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    writer = type(spark.range(1).write)
    real = writer.parquet
    monkeypatch.setattr(writer, "parquet", lambda self, *a, **k: seen.append(int(spark.conf.get(name))) or real(self, *a, **k))
    before = spark.conf.get(name)
    halves = R.S.hash_split_written(spark.range(50).selectExpr("id AS k"), 0.5, ["k"])
    assert seen[0] > 2 and spark.conf.get(name) == before
    assert sorted(r["k"] for h in halves for r in h.collect()) == list(range(50)) and all(h.count() for h in halves)


def test_only_forests_are_laid_out(spark, tmp_path, monkeypatch):
    d, seen, laid_out = lineitem(spark, tmp_path), [], M.laid_out

    @contextmanager
    def counted(train, *rest):
        seen.append(train.columns)
        with laid_out(train, *rest) as rows:
            yield rows

    monkeypatch.setattr(M, "laid_out", counted)
    for query, columns in (("score_rows", []), ("linear_regression_certificate", []), ("model_roundtrip", []), ("delay_classifier", []),
                           ("model_comparison_exact", [[*R.KEYS, "DepDelay", "ArrDelay"]])):
        seen.clear()
        assert R.QUERIES[query](spark, d).count() and seen == columns


def test_iterative_fits_get_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(M, "TRAIN_PARTITION_ROWS", 10)
    rows = spark.range(300).selectExpr("CAST(id % 7 AS double) AS x", "CAST(id % 2 AS double) AS is_delayed", "1.0D AS class_weight")
    asked = []
    real = type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda self, n, *c: asked.append(n) or real(self, n, *c))
    M.fit_persisted(M.delay_classifier(["x"], max_iter=2), rows)
    M.fit_persisted(M.linear_regression(["x"], label="is_delayed"), rows)
    assert asked == [30]


def test_correlation_leaves_rows_out_after_the_write(spark, monkeypatch):
    given, real = [], R.P.written
    monkeypatch.setattr(R.P, "written", lambda df, *a: given.append(df.count()) or real(df, *a))
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (float("nan"), 1.0), (4.0, 9.0)], "a double, b double")
    plain = rows.na.drop().agg(F.corr("a", "b")).first()[0]
    found = {(r["col_x"], r["col_y"]): r["r"] for r in R.P.correlation_matrix(rows, ["a", "b"]).collect()}
    assert given == [5] and abs(found["a", "b"] - plain) < 1e-12
