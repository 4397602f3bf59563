"""Registered queries: one per operator of the survey's inventory.

Every query reads the driver's tables (the flight view is a projection of
``lineitem``; the dimension join also reads ``supplier`` and ``nation``) and
runs over all rows.  Each has a DuckDB twin in ``SQL`` unless its result is
not reproducible outside Spark (seeded per-partition sampling, model fits),
in which case only its row count is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.functions.expressions import (
    cyclical,
    delay_bucket,
    delayed_flag,
    hhmm_hour,
    minutes_of_day,
    quick_round,
)
from ontime.operators import cleaning as C
from ontime.operators import gradient as G
from ontime.operators import ml as M
from ontime.operators import profile as P
from ontime.operators import quantiles as Q
from ontime.operators import rates as R
from ontime.operators import sampling as S
from ontime.operators import sketches as K
from ontime.operators import splits as L
from ontime.plans.oracle import HASH_KEY, TEST_BOUND, null_safe_hash, with_ctes
from ontime.plans.stages import load_and_clean, transformed_layer
from ontime.schema import (
    FEATURE_COLUMNS,
    FEATURE_TYPES,
    LABEL,
    MODEL_FEATURES,
    PARTITION_KEYS,
    TRANSFORM_NUMERICS,
    raw_schema_typed,
)
from ontime.session import scratch_path
from ontime.sources.catalog import (
    Candidate,
    drop_table,
    list_tables,
    load_first,
    refresh,
    register_external,
    save_as_table,
    save_bucketed,
    scan_table,
    sync_partitions,
)
from ontime.sources.files import path_exists, read_csv_raw, read_csv_typed, read_parquet
from ontime.sources.fixture import flights, flights_from_lineitem, read_table, table_path
from ontime.sources.reconcile import conflict_report, reconciled_scan, reconciled_table, schema_groups
from ontime.sources.rejects import ingest_csv
from ontime.sources.sinks import write_layer, written
from ontime.streaming import ingest_stream, run_until_caught_up

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

KEYS = ["l_orderkey", "l_linenumber"]
# Quantile probabilities of the target profile.
PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
SUMMARY_COLS = ["ArrDelay", "DepDelay", "Distance", "TaxiIn", "TaxiOut"]
FL_TYPES_EXTRA = {"UniqueCarrier": "string", "Origin": "bigint", "l_orderkey": "bigint", "l_linenumber": "int"}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- layers used by many queries

def fl(spark: SparkSession, d: str) -> DataFrame:
    return flights(spark, d)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_target(fl(spark, d))


def features(spark: SparkSession, d: str) -> DataFrame:
    return C.typed_features(clean(spark, d)).df


def raw_features(spark: SparkSession, d: str) -> DataFrame:
    return C.typed_features(fl(spark, d)).df


def transformed(spark: SparkSession, d: str) -> DataFrame:
    return transformed_layer(features(spark, d)).df


def r6(c, n: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# ---------------------------------------------------------------- sources and sinks


@query("parquet_scan", with_ctes("SELECT * FROM fl", "fl"))
def q_parquet_scan(spark, d):
    return flights_from_lineitem(read_parquet(spark, table_path(d, "lineitem")))


_CSV: dict[tuple[str, str], str] = {}


def _fl_csv(spark, d) -> str:
    """The flight view as CSV: written once per session and folder, read by every query that needs a CSV."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _CSV or not path_exists(spark, _CSV[key]):
        path = scratch_path(spark, "fl-csv")
        fl(spark, d).write.option("header", "true").csv(path)
        _CSV[key] = path
    return _CSV[key]


@query("csv_scan", with_ctes("SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in
    ["Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime", "DepDelay",
     "ArrDelay", "Distance", "Cancelled", "TaxiIn", "TaxiOut", "UniqueCarrier", "Origin", "l_orderkey",
     "l_linenumber"]) + " FROM fl", "fl"))
def q_csv_scan(spark, d):
    return read_csv_raw(spark, _fl_csv(spark, d))


@query("csv_typed", with_ctes("SELECT * FROM fl_typed", "fl_typed"))
def q_csv_typed(spark, d):
    return read_csv_typed(spark, _fl_csv(spark, d), types=FL_TYPES_EXTRA)


def _write_features(spark, d, partitioned: bool) -> str:
    path = scratch_path(spark, "features")
    write_layer(features(spark, d), path, PARTITION_KEYS if partitioned else None)
    return path


@query("parquet_roundtrip_partitioned", with_ctes("SELECT * FROM features", "features"))
def q_parquet_roundtrip_partitioned(spark, d):
    path = _write_features(spark, d, partitioned=True)
    return read_parquet(spark, path).select(*FEATURE_COLUMNS)


@query("parquet_roundtrip_flat", with_ctes("SELECT * FROM features", "features"))
def q_parquet_roundtrip_flat(spark, d):
    path = _write_features(spark, d, partitioned=False)
    return read_parquet(spark, path).select(*FEATURE_COLUMNS)


@query("table_scan", with_ctes("SELECT * FROM features", "features"))
def q_table_scan(spark, d):
    register_external(spark, "ontime_features_flat", _write_features(spark, d, partitioned=False))
    return scan_table(spark, "ontime_features_flat").select(*FEATURE_COLUMNS)


@query("external_table_count", with_ctes(
    "SELECT Year, COUNT(*) AS cnt FROM features GROUP BY Year", "features"))
def q_external_table_count(spark, d):
    path = _write_features(spark, d, partitioned=True)
    return P.count_by(register_external(spark, "ontime_features_by_month", path), ["Year"])


@query("layer_overwrite_replaces", with_ctes("SELECT * FROM features WHERE Month <= 6", "features"))
def q_layer_overwrite_replaces(spark, d):
    """All months, then an overwrite with the first six: nothing of the others is left."""
    path = scratch_path(spark, "overwritten")
    write_layer(features(spark, d), path, PARTITION_KEYS)
    write_layer(features(spark, d).filter(F.col("Month") <= 6), path, PARTITION_KEYS)
    return read_parquet(spark, path).select(*FEATURE_COLUMNS)


@query("layer_overwrite_partitions", with_ctes(
    "SELECT * FROM features WHERE Month > 6 UNION ALL SELECT * FROM features WHERE Month <= 6 AND DayOfWeek = 1",
    "features"))
def q_layer_overwrite_partitions(spark, d):
    """The opt-in form: only the partitions in the new data are replaced."""
    path = scratch_path(spark, "overwritten")
    write_layer(features(spark, d), path, PARTITION_KEYS)
    part = features(spark, d).filter("Month <= 6")
    keys = part.select(*PARTITION_KEYS).distinct()
    write_layer(part.filter("DayOfWeek = 1"), path, PARTITION_KEYS, only_partitions=True)
    kept = read_parquet(spark, path).select(*FEATURE_COLUMNS)
    # A month without a Monday keeps its old rows; the fixture has none.
    return kept.join(keys, PARTITION_KEYS, "left").select(*FEATURE_COLUMNS)


@query("merge_schema_scan", with_ctes(
    "SELECT l_orderkey, Distance, NULL AS TaxiIn FROM fl WHERE Month <= 6 UNION ALL "
    "SELECT l_orderkey, NULL AS Distance, TaxiIn FROM fl WHERE Month > 6", "fl"))
def q_merge_schema_scan(spark, d):
    """Two files of different columns read as one table."""
    path = scratch_path(spark, "merged")
    fl(spark, d).filter("Month <= 6").select("l_orderkey", "Distance").write.parquet(f"{path}/part=1")
    fl(spark, d).filter("Month > 6").select("l_orderkey", "TaxiIn").write.parquet(f"{path}/part=2")
    return read_parquet(spark, path, merge_schema=True).select("l_orderkey", "Distance", "TaxiIn")


def _conflicting_layers(spark, d) -> str:
    """A layer by month whose types changed twice: integers, then text, then other numbers and another column."""
    path, rows = scratch_path(spark, "conflicting"), fl(spark, d)
    whole, number = (lambda c: F.col(c).try_cast("int").alias(c)), (lambda c: F.col(c).try_cast("double").alias(c))
    parts = [(1, 4, [whole("Distance"), number("DepDelay"), whole("TaxiIn")]),
             (5, 8, [F.col("Distance").cast("bigint").alias("Distance"), F.col("DepDelay"), number("TaxiIn")]),
             (9, 12, [number("Distance"), whole("DepDelay"), F.col("UniqueCarrier")])]
    for low, high, columns in parts:
        part = rows.filter(F.col("Month").between(low, high)).select(*KEYS, *columns, "Month")
        write_layer(part, path, ["Month"], mode="append")
    return path


RECONCILED = ("SELECT l_orderkey, l_linenumber, CAST(Distance AS DOUBLE) AS Distance, TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, "
              "CASE WHEN Month <= 8 THEN CAST(TaxiIn AS DOUBLE) END AS TaxiIn, CASE WHEN Month >= 9 THEN UniqueCarrier END "
              "AS UniqueCarrier, Month FROM fl")


@query("reconciled_scan", with_ctes(RECONCILED, "fl"))
def q_reconciled_scan(spark, d):
    """Files that disagree on types read as one table; the delay, text in some, is asked for as a number."""
    return reconciled_scan(spark, _conflicting_layers(spark, d), {"DepDelay": T.DoubleType()})


@query("schema_conflicts", "SELECT * FROM (VALUES ('Distance', 'int', 'double'), ('Distance', 'bigint', 'double'), "
       "('Distance', 'double', 'double'), ('DepDelay', 'double', 'string'), ('DepDelay', 'string', 'string'), "
       "('DepDelay', 'int', 'string'), ('TaxiIn', 'int', 'double'), ('TaxiIn', 'double', 'double')) v(\"column\", \"type\", target)")
def q_schema_conflicts(spark, d):
    """The columns whose types differ between the files, and the type that holds them all."""
    return conflict_report(schema_groups(spark, _conflicting_layers(spark, d)), spark).drop("files")


@query("declared_table", with_ctes(
    "SELECT c AS \"column\", t AS \"type\", n FROM (VALUES " + ", ".join(
        f"('{c}', '{t}', (SELECT COUNT({c}) FROM rec))" for c, t in [
            ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("Distance", "double"), ("DepDelay", "double"),
            ("TaxiIn", "double"), ("UniqueCarrier", "string"), ("Month", "int")]) + ") v(c, t, n)", "fl",
    extra=f"rec AS ({RECONCILED})"))
def q_declared_table(spark, d):
    """The reconciled layer as a table with generated column types (S13): its catalog types and values by column."""
    table = reconciled_table(spark, _conflicting_layers(spark, d), "ontime_declared", scratch_path(spark, "declared"), ["Month"],
                             {"DepDelay": T.DoubleType()})
    types = {c.name: c.dataType for c in spark.catalog.listColumns("ontime_declared")}
    counts = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.count(c).alias("n")) for c in table.columns])
    return table.agg(counts.alias("c")).select(F.inline("c"))


def _fl_schema(spark, d) -> T.StructType:
    schema = raw_schema_typed(list(FL_TYPES_EXTRA.items()))
    return T.StructType([schema[c] for c in fl(spark, d).columns])


def _damaged_csv(spark, d) -> str:
    """The flight CSV with damaged lines: text in a number, a field too many, a field too few."""
    path, rows = scratch_path(spark, "damaged-csv"), fl(spark, d)
    rows.filter("l_orderkey % 31 > 2").write.option("header", "true").csv(path)
    line = F.concat_ws(",", *[F.when(F.lit(c) == "Distance", F.concat(c, F.when(F.col("l_orderkey") % 31 == 0, " miles").otherwise("")))
                              .otherwise(F.col(c).cast("string")) for c in rows.columns[:-1]])
    end = F.when(F.col("l_orderkey") % 31 == 1, F.concat(F.lit(","), "l_linenumber", F.lit(",surplus"))) \
        .when(F.col("l_orderkey") % 31 == 2, "").otherwise(F.concat(F.lit(","), "l_linenumber"))
    rows.filter("l_orderkey % 31 <= 2").select(F.concat(line, end).alias("value")).write.mode("append").text(path)
    return path


_LINE_SQL = ("DepTime || ',' || CRSDepTime || ',' || ArrTime || ',' || CRSArrTime || ',' || DepDelay || ',' || ArrDelay || ',' || Distance "
             "|| CASE WHEN l_orderkey % 31 = 0 THEN ' miles' ELSE '' END || ',' || Cancelled || ',' || TaxiIn || ',' || TaxiOut || ',' "
             "|| UniqueCarrier || ',' || Origin || ',' || l_orderkey || CASE l_orderkey % 31 WHEN 0 THEN ',' || l_linenumber "
             "WHEN 1 THEN ',' || l_linenumber || ',surplus' ELSE '' END")


@query("csv_rejects", with_ctes(
    f"SELECT Year || ',' || Month || ',' || DayofMonth || ',' || DayOfWeek || ',' || {_LINE_SQL} AS line, "
    "CASE WHEN l_orderkey % 31 = 0 THEN 'Distance: ' || Distance || ' miles' ELSE 'fields' END AS reason FROM fl "
    "WHERE l_orderkey % 31 <= 2", "fl"))
def q_csv_rejects(spark, d):
    """The rejected lines of a damaged CSV with their reasons, written in the pass that writes the accepted rows."""
    found = ingest_csv(spark, _damaged_csv(spark, d), scratch_path(spark, "checked"), _fl_schema(spark, d), PARTITION_KEYS)
    return found.rejected.select("line", F.concat_ws("; ", "reasons").alias("reason"))


@query("csv_accepted", with_ctes("SELECT * FROM fl_typed WHERE l_orderkey % 31 > 2", "fl_typed"))
def q_csv_accepted(spark, d):
    """The accepted rows of the same CSV, typed."""
    return ingest_csv(spark, _damaged_csv(spark, d), scratch_path(spark, "checked"), _fl_schema(spark, d), PARTITION_KEYS).accepted


def _changed_layer(spark, d, table: str) -> None:
    """A registered layer of the first six months whose files were then replaced by those of March to September."""
    path = scratch_path(spark, "changed")
    write_layer(features(spark, d).filter("Month <= 6"), path, PARTITION_KEYS)
    register_external(spark, table, path)
    write_layer(features(spark, d).filter("Month BETWEEN 3 AND 9"), path, PARTITION_KEYS)


@query("partition_diff", with_ctes(
    "SELECT DISTINCT 'Year=' || Year || '/Month=' || Month AS \"partition\", CASE WHEN Month <= 2 THEN 'drop' ELSE 'add' END AS change "
    "FROM features WHERE Month IN (1, 2, 7, 8, 9)", "features"))
def q_partition_diff(spark, d):
    """Partitions that the catalog is told of after months came and went, and no others."""
    _changed_layer(spark, d, "ontime_changed")
    return sync_partitions(spark, "ontime_changed")


@query("partition_sync_count", with_ctes(
    "SELECT Year, Month, COUNT(*) AS cnt FROM features WHERE Month BETWEEN 3 AND 9 GROUP BY Year, Month", "features"))
def q_partition_sync_count(spark, d):
    """Rows by partition of the table brought into step."""
    _changed_layer(spark, d, "ontime_synced")
    sync_partitions(spark, "ontime_synced")
    return P.count_by(scan_table(spark, "ontime_synced"), PARTITION_KEYS)


BUCKETS = 8


@query("bucketed_counts", with_ctes(
    "SELECT Origin, COUNT(*) AS n, round(AVG(ArrDelay), 6) AS avg_delay FROM clean GROUP BY Origin", "clean"))
def q_bucketed_counts(spark, d):
    """Counts by origin from a table bucketed by origin: aggregated where the rows lie."""
    table = save_bucketed(clean(spark, d).select("Origin", "ArrDelay"), "ontime_bucketed", scratch_path(spark, "bucketed"),
                          ["Origin"], BUCKETS)
    return table.groupBy("Origin").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ArrDelay")).alias("avg_delay"))


@query("bucketed_join", with_ctes(
    "SELECT o_orderpriority, COUNT(*) AS n, round(AVG(ArrDelay), 6) AS avg_delay FROM clean JOIN orders ON l_orderkey = o_orderkey "
    "GROUP BY o_orderpriority", "clean"))
def q_bucketed_join(spark, d):
    """Flights and orders, both bucketed by order, joined without a shuffle of either."""
    left = save_bucketed(clean(spark, d).select("l_orderkey", "ArrDelay"), "ontime_flights_by_order",
                         scratch_path(spark, "bucketed"), ["l_orderkey"], BUCKETS)
    right = save_bucketed(read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "ontime_orders_by_order",
                          scratch_path(spark, "bucketed"), ["o_orderkey"], BUCKETS)
    joined = left.hint("merge").join(right, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("ArrDelay")).alias("avg_delay"))


@query("flat_without_keys", with_ctes("SELECT DepDelay, ArrDelay FROM features", "features"))
def q_flat_without_keys(spark, d):
    """A layer without its partition columns is written flat."""
    path = scratch_path(spark, "flat")
    write_layer(features(spark, d).select("DepDelay", "ArrDelay"), path, PARTITION_KEYS)
    return read_parquet(spark, path)


@query("register_if_absent", with_ctes("SELECT COUNT(*) AS cnt FROM features WHERE Month <= 6", "features"))
def q_register_if_absent(spark, d):
    """A second registration without ``replace`` keeps the first table (S14); then it is dropped."""
    first, second = scratch_path(spark, "first"), scratch_path(spark, "second")
    write_layer(features(spark, d).filter("Month <= 6"), first)
    write_layer(features(spark, d), second)
    drop_table(spark, "ontime_if_absent")
    register_external(spark, "ontime_if_absent", first, replace=False)
    count = P.row_count(register_external(spark, "ontime_if_absent", second, replace=False)).first()["cnt"]
    drop_table(spark, "ontime_if_absent")
    return spark.createDataFrame([(count,)], "cnt bigint")


@query("save_as_table", with_ctes("SELECT Year, Month, COUNT(*) AS cnt FROM features GROUP BY Year, Month",
                                  "features"))
def q_save_as_table(spark, d):
    """Write and register in one step."""
    drop_table(spark, "ontime_saved")
    saved = save_as_table(features(spark, d), "ontime_saved", scratch_path(spark, "saved"), PARTITION_KEYS)
    return P.count_by(saved, PARTITION_KEYS)


@query("refresh_sees_new_files", with_ctes("SELECT COUNT(*) AS cnt FROM features", "features"))
def q_refresh_sees_new_files(spark, d):
    """Files added beside a registered table count after ``refresh``."""
    path = scratch_path(spark, "grown")
    write_layer(features(spark, d).filter("Month <= 6"), path)
    register_external(spark, "ontime_grown", path)
    write_layer(features(spark, d).filter("Month > 6"), path, mode="append")
    refresh(spark, "ontime_grown")
    return P.row_count(scan_table(spark, "ontime_grown"))


@query("catalog_lists_table", with_ctes(
    "SELECT 'ontime_listed' AS name, FALSE AS isTemporary, COUNT(*) > 0 AS has_rows FROM features", "features"))
def q_catalog_lists_table(spark, d):
    """A registered layer is listed and isn't empty."""
    table = register_external(spark, "ontime_listed", _write_features(spark, d, partitioned=False))
    return (list_tables(spark, pattern="ontime_listed").select("name", "isTemporary")
            .withColumn("has_rows", F.lit(not P.is_empty(table))))


@query("month_partition_filter", with_ctes(
    "SELECT Year, Month, COUNT(*) AS cnt, AVG(ArrDelay) AS avg_delay FROM features "
    "WHERE Month = 6 GROUP BY Year, Month", "features"))
def q_month_partition_filter(spark, d):
    """A Month filter on the partitioned layer prunes directories (PartitionFilters)."""
    path = _write_features(spark, d, partitioned=True)
    t = read_parquet(spark, path).filter(F.col("Month") == 6)
    return t.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("cnt"), F.avg("ArrDelay").alias("avg_delay"))


@query("load_first_source", with_ctes("SELECT * FROM clean", "clean"))
def q_load_first_source(spark, d):
    missing_path = scratch_path(spark, "not-written")
    src, _ = load_first(spark, [Candidate("table", "default.no_such_flights_table"),
                                Candidate("parquet", missing_path),
                                Candidate("parquet", table_path(d, "lineitem"))])
    return C.clean_target(flights_from_lineitem(src))


@query("load_and_clean", with_ctes(
    "SELECT * FROM fl_typed WHERE ArrDelay IS NOT NULL AND NOT isnan(ArrDelay)", "fl_typed"))
def q_load_and_clean(spark, d):
    csv = _fl_csv(spark, d)
    df, _ = load_and_clean(spark, [Candidate("table", "default.no_such_flights_table"),
                                   Candidate("parquet", scratch_path(spark, "not-written")),
                                   Candidate("csv", csv)])
    # The CSV reader declares the flight columns; the pass-through ones get their types here.
    return C.cast_columns(df, FL_TYPES_EXTRA)


@query("stream_ingest", with_ctes("SELECT * FROM fl_typed WHERE Year IS NOT NULL AND Month IS NOT NULL",
                                  "fl_typed"))
def q_stream_ingest(spark, d):
    """The ETL step as a Structured Streaming query (CSV files -> partitioned Parquet)."""
    csv = _fl_csv(spark, d)
    extra = [(c, t) for c, t in FL_TYPES_EXTRA.items()]
    schema = raw_schema_typed(extra)
    # The CSV columns come in the flight view's order; declare them in that order.
    order = fl(spark, d).columns
    schema = T.StructType([schema[c] for c in order])
    out = scratch_path(spark, "ingested")
    run_until_caught_up(ingest_stream(spark, csv, out, schema=schema))
    return read_parquet(spark, out).select(*order)


# ---------------------------------------------------------------- projection, filter, expressions

@query("select_existing", with_ctes("SELECT Year, Month, ArrDelay, Distance FROM fl", "fl"))
def q_select_existing(spark, d):
    return C.select_existing(fl(spark, d), ["Year", "Month", "ArrDelay", "NoSuchColumn", "Distance"]).df


@query("typed_features", with_ctes("SELECT * FROM features", "features"))
def q_typed_features(spark, d):
    return features(spark, d)


@query("decimal_text_integers", with_ctes(
    "SELECT l_orderkey, l_linenumber, CAST(trunc(TRY_CAST(CASE WHEN DepTime = 'NA' THEN DepTime ELSE DepTime || '.75' END "
    "AS DOUBLE)) AS INT) AS DepTime, Distance FROM fl", "fl"))
def q_decimal_text_integers(spark, d):
    """Decimal text in integer columns is cut towards zero, through the CSV reader and the cast alike."""
    text = fl(spark, d).select(*KEYS, F.when(F.col("DepTime") == "NA", "NA").otherwise(
        F.concat("DepTime", F.lit(".75"))).alias("DepTime"), F.concat(F.col("Distance"), F.lit(".0")).alias("Distance"))
    path = scratch_path(spark, "decimal-csv")
    text.write.option("header", "true").csv(path)
    types = {"Distance": "int", "l_orderkey": "bigint", "l_linenumber": "int"}
    return C.cast_columns(read_csv_typed(spark, path, types=types), {"Distance": "int"})


@query("column_aliases", with_ctes("SELECT * FROM raw_features", "raw_features"))
def q_column_aliases(spark, d):
    variant = fl(spark, d).withColumnsRenamed({"DayofMonth": "DayOfMonth", "Cancelled": "Canceled"})
    return C.typed_features(variant).df


@query("dropna_subset", with_ctes(
    "SELECT * FROM raw_features WHERE Year IS NOT NULL AND Month IS NOT NULL AND DepTime IS NOT NULL",
    "raw_features"))
def q_dropna_subset(spark, d):
    return C.dropna_subset(raw_features(spark, d), ["Year", "Month", "DepTime"])


@query("cast_double_safe", with_ctes(
    "SELECT l_orderkey, l_linenumber, TRY_CAST(ArrDelay AS DOUBLE) AS ArrDelay FROM fl", "fl"))
def q_cast_double_safe(spark, d):
    return C.cast_target(fl(spark, d)).select(*KEYS, "ArrDelay")


@query("clean_target", with_ctes("SELECT * FROM clean", "clean"))
def q_clean_target(spark, d):
    return clean(spark, d)


@query("cleaning_report", with_ctes(
    "SELECT COUNT(*) AS rows_before, "
    "COUNT(*) FILTER (WHERE TRY_CAST(ArrDelay AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(ArrDelay AS DOUBLE))) "
    "AS rows_after, rows_before - rows_after AS rows_removed FROM fl", "fl"))
def q_cleaning_report(spark, d):
    return C.cleaning_report(fl(spark, d))


BUCKET_SQL = ("CASE WHEN ArrDelay IS NULL OR isnan(ArrDelay) THEN 'unknown' WHEN ArrDelay <= -15 THEN '<= -15' "
              "WHEN ArrDelay > -15 AND ArrDelay <= 0 THEN '(-15,0]' WHEN ArrDelay > 0 AND ArrDelay < 15 THEN '(0,15)' "
              "ELSE '>= 15' END")


@query("delay_bucket_rows", with_ctes(
    f"SELECT l_orderkey, l_linenumber, ArrDelay, {BUCKET_SQL} AS delay_bucket FROM clean", "clean"))
def q_delay_bucket_rows(spark, d):
    return clean(spark, d).select(*KEYS, "ArrDelay", delay_bucket("ArrDelay").alias("delay_bucket"))


@query("delayed_flag", with_ctes(
    "SELECT l_orderkey, l_linenumber, ArrDelay, CAST(ArrDelay >= 15 AS INT) AS is_delayed FROM clean", "clean"))
def q_delayed_flag(spark, d):
    return clean(spark, d).select(*KEYS, "ArrDelay", delayed_flag("ArrDelay").alias("is_delayed"))


@query("hhmm_hour", with_ctes(
    "SELECT l_orderkey, l_linenumber, DepTime, CAST(trunc(DepTime / 100) AS INT) AS DepHour, "
    "ArrTime, CAST(trunc(ArrTime / 100) AS INT) AS ArrHour, "
    "CAST(trunc(ArrTime / 100) AS INT) % 24 AS ArrHour24 FROM fl_typed", "fl_typed"))
def q_hhmm_hour(spark, d):
    t = C.cast_columns(fl(spark, d), {"DepTime": "int", "ArrTime": "int"})
    return t.select(*KEYS, "DepTime", hhmm_hour("DepTime").alias("DepHour"), "ArrTime",
                    hhmm_hour("ArrTime").alias("ArrHour"), hhmm_hour("ArrTime", wrap24=True).alias("ArrHour24"))


@query("bulk_cast", with_ctes(
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in TRANSFORM_NUMERICS)
    + " FROM fl", "fl"))
def q_bulk_cast(spark, d):
    return C.cast_columns(fl(spark, d), {c: "double" for c in TRANSFORM_NUMERICS}).select(*KEYS, *TRANSFORM_NUMERICS)


@query("not_cancelled", with_ctes("SELECT * FROM raw_features WHERE Cancelled = 0", "raw_features"))
def q_not_cancelled(spark, d):
    return C.not_cancelled(raw_features(spark, d))


@query("drop_rename", with_ctes(
    "SELECT * EXCLUDE (Year, Cancelled, ArrDelay), ArrDelay AS ArrDelayMinutes FROM clean", "clean"))
def q_drop_rename(spark, d):
    return C.drop_and_rename(clean(spark, d), drop=["Year", "Cancelled", "NoSuchColumn"],
                             rename={"ArrDelay": "ArrDelayMinutes"})


@query("dropna_any", with_ctes("SELECT * FROM raw_features WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in FEATURE_COLUMNS), "raw_features"))
def q_dropna_any(spark, d):
    return C.dropna_any(raw_features(spark, d))


@query("numeric_columns", with_ctes(
    "SELECT Year, Month, DayofMonth, DayOfWeek, CRSDepTime, CRSArrTime, Distance, Cancelled, TaxiIn, TaxiOut, "
    "Origin, l_orderkey, l_linenumber FROM fl", "fl"))
def q_numeric_columns(spark, d):
    df = fl(spark, d)
    return df.select(*C.numeric_columns(df))


@query("first_k_features", with_ctes(
    "SELECT Year, Month, DayofMonth, DayOfWeek FROM features", "features"))
def q_first_k_features(spark, d):
    df = features(spark, d)
    return df.select(*C.first_k_features(df, k=4))


@query("schema_frame", with_ctes("SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(FEATURE_TYPES.items()))
    + ") AS v(\"position\", \"column\", \"type\")", "features"))
def q_schema_frame(spark, d):
    return C.describe_schema(features(spark, d)).drop("nullable")


@query("winsorize", with_ctes(
    "SELECT l_orderkey, l_linenumber, ArrDelay, round(least(greatest(ArrDelay, "
    "(SELECT quantile_cont(ArrDelay, 0.01) FROM clean)), (SELECT quantile_cont(ArrDelay, 0.99) FROM clean)), 6) "
    "AS ArrDelay_clipped FROM clean", "clean"))
def q_winsorize(spark, d):
    out = Q.winsorize(clean(spark, d), "ArrDelay", 0.01, 0.99, output="ArrDelay_clipped")
    return out.select(*KEYS, "ArrDelay", r6("ArrDelay_clipped").alias("ArrDelay_clipped"))


@query("cyclical_time", with_ctes(
    "SELECT l_orderkey, l_linenumber, CRSDepTime, "
    "CAST(floor(CRSDepTime / 100) * 60 + (CRSDepTime % 100) AS INT) AS dep_minutes, "
    "round(sin(CAST(floor(CRSDepTime / 100) * 60 + (CRSDepTime % 100) AS DOUBLE) * (2 * pi() / 1440)), 6) AS dep_sin, "
    "round(cos(CAST(floor(CRSDepTime / 100) * 60 + (CRSDepTime % 100) AS DOUBLE) * (2 * pi() / 1440)), 6) AS dep_cos "
    "FROM fl", "fl"))
def q_cyclical_time(spark, d):
    m = minutes_of_day("CRSDepTime")
    s, c = cyclical(m)
    return fl(spark, d).select(*KEYS, "CRSDepTime", m.alias("dep_minutes"), r6(s).alias("dep_sin"),
                               r6(c).alias("dep_cos"))


# ---------------------------------------------------------------- aggregation and profiling

@query("row_count", with_ctes("SELECT COUNT(*) AS cnt FROM fl", "fl"))
def q_row_count(spark, d):
    return P.row_count(fl(spark, d))


@query("count_by_year", with_ctes("SELECT Year, COUNT(*) AS cnt FROM fl GROUP BY Year ORDER BY Year", "fl"))
def q_count_by_year(spark, d):
    return P.count_by(fl(spark, d), ["Year"])


def _summary_sql(cols: list[str], src: str) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, round(AVG({c}), 6) AS mean, "
            f"round(STDDEV_SAMP({c}), 6) AS stddev, MIN({c}) AS min, MAX({c}) AS max FROM {src}")
    return " UNION ALL ".join(parts)


def _round_summary(df: DataFrame) -> DataFrame:
    return df.select("column", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"), "min", "max")


@query("numeric_summary", with_ctes(_summary_sql(SUMMARY_COLS, "features"), "features"))
def q_numeric_summary(spark, d):
    return _round_summary(P.numeric_summary(features(spark, d), SUMMARY_COLS))


def _quantile_sql(cols: list[str], probs: list[float], src: str, fn: str = "quantile_disc") -> str:
    parts = []
    for c in cols:
        for p in probs:
            parts.append(f"SELECT '{c}' AS \"column\", CAST({p!r} AS DOUBLE) AS probability, "
                         f"round(CAST({fn}({c}, {p!r}) AS DOUBLE), 6) AS value FROM {src} "
                         f"WHERE {c} IS NOT NULL AND NOT isnan({c})")
    return " UNION ALL ".join(parts)


@query("quantiles_exact", with_ctes(_quantile_sql(["ArrDelay", "DepDelay", "Distance"], PROBS, "features"),
                                    "features"))
def q_quantiles_exact(spark, d):
    q = Q.quantiles_disc(features(spark, d), ["ArrDelay", "DepDelay", "Distance"], PROBS)
    return q.select("column", "probability", r6("value").alias("value"))


@query("quantiles_cont", with_ctes(_quantile_sql(["ArrDelay", "DepDelay", "Distance"], PROBS, "features",
                                                 "quantile_cont"), "features"))
def q_quantiles_cont(spark, d):
    q = Q.quantiles_cont(features(spark, d), ["ArrDelay", "DepDelay", "Distance"], PROBS)
    return q.select("column", "probability", r6("value").alias("value"))


QUANTILE_COLS = ["ArrDelay", "DepDelay", "Distance"]


@query("quantiles_approx", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p!r} AS DOUBLE) AS probability, COUNT({c}) AS n, TRUE AS within FROM features"
    for c in QUANTILE_COLS for p in PROBS), "features"))
def q_quantiles_approx(spark, d):
    """Approximate quantiles and whether their rank, counted in the data, is within the stated error."""
    error = 0.001
    df = features(spark, d)
    return K.ranks_within(df, Q.quantiles_approx(df, QUANTILE_COLS, PROBS, error), error)


def _stored_sketches(spark, d) -> DataFrame:
    """Sketches by year and month, stored in two loads of which the second is repeated."""
    path, df = scratch_path(spark, "sketches"), features(spark, d)
    K.store_sketches(df.filter("Month <= 6"), QUANTILE_COLS, PARTITION_KEYS, path, "first half")
    for _ in range(2):
        K.store_sketches(df.filter("Month > 6"), QUANTILE_COLS, PARTITION_KEYS, path, "second half")
    return K.read_sketches(spark, path)


@query("quantiles_merged", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p!r} AS DOUBLE) AS probability, COUNT({c}) AS n, TRUE AS within "
    "FROM features WHERE Month BETWEEN 3 AND 9" for c in QUANTILE_COLS for p in PROBS), "features"))
def q_quantiles_merged(spark, d):
    """March to September from stored monthly sketches; the ranks of the answers, counted in the rows, are within the error."""
    found = K.merged_quantiles(_stored_sketches(spark, d).filter("Month BETWEEN 3 AND 9"), PROBS)
    found = spark.createDataFrame(found.collect(), found.schema)  # columns x probabilities
    return K.ranks_within(features(spark, d).filter("Month BETWEEN 3 AND 9"), found, K.rank_error())


@query("summary_merged", with_ctes(_summary_sql(QUANTILE_COLS, "(SELECT * FROM features WHERE Month BETWEEN 3 AND 9)"), "features"))
def q_summary_merged(spark, d):
    """Count, mean, deviation and bounds of March to September from the stored months, without their rows (A3)."""
    return _round_summary(K.merged_summary(_stored_sketches(spark, d).filter("Month BETWEEN 3 AND 9")))


@query("sketch_bounds_by_year", with_ctes(" UNION ALL ".join(
    f"SELECT Year, '{c}' AS \"column\", COUNT({c}) AS n, MIN({c}) AS least, MAX({c}) AS greatest FROM features "
    f"GROUP BY Year HAVING COUNT({c}) > 0" for c in QUANTILE_COLS), "features"))
def q_sketch_bounds_by_year(spark, d):
    """Exact counts and bounds of each year from the stored sketches of its months."""
    found = K.merged_quantiles(_stored_sketches(spark, d), [0.0, 1.0], ["Year"])
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    return found.groupBy("Year", "column", "n").agg(at(0.0).alias("least"), at(1.0).alias("greatest"))


@query("iqr", with_ctes(
    "SELECT 'ArrDelay' AS \"column\", CAST(quantile_disc(ArrDelay, 0.25) AS DOUBLE) AS q25, "
    "CAST(quantile_disc(ArrDelay, 0.75) AS DOUBLE) AS q75, q75 - q25 AS iqr FROM clean", "clean"))
def q_iqr(spark, d):
    return P.iqr(clean(spark, d), "ArrDelay")


def _tidy_sql() -> str:
    names = ["count", "mean", "stddev", "min", "q1 (1%)", "q5 (5%)", "q1 (25%)", "median (50%)", "q3 (75%)",
             "IQR (q3-q1)", "q95", "q99", "max"]
    exprs = {
        "count": "CAST(COUNT(ArrDelay) AS DOUBLE)", "mean": "AVG(ArrDelay)", "stddev": "STDDEV_SAMP(ArrDelay)",
        "min": "MIN(ArrDelay)", "max": "MAX(ArrDelay)",
        "q1 (1%)": "quantile_disc(ArrDelay, 0.01)", "q5 (5%)": "quantile_disc(ArrDelay, 0.05)",
        "q1 (25%)": "quantile_disc(ArrDelay, 0.25)", "median (50%)": "quantile_disc(ArrDelay, 0.5)",
        "q3 (75%)": "quantile_disc(ArrDelay, 0.75)", "q95": "quantile_disc(ArrDelay, 0.95)",
        "q99": "quantile_disc(ArrDelay, 0.99)",
        "IQR (q3-q1)": "quantile_disc(ArrDelay, 0.75) - quantile_disc(ArrDelay, 0.25)",
    }
    return " UNION ALL ".join(
        f"SELECT {i} AS ord, '{m}' AS metric, round(CAST({exprs[m]} AS DOUBLE), 6) AS value FROM clean"
        for i, m in enumerate(names))


@query("tidy_profile", with_ctes(_tidy_sql(), "clean"))
def q_tidy_profile(spark, d):
    return P.tidy_profile(clean(spark, d), "ArrDelay").select("ord", "metric", r6("value").alias("value"))


PCT_SQL = "round(CAST({n} AS DOUBLE) / CAST({t} AS DOUBLE) * 100.0, 3)"


@query("bucket_summary", with_ctes(
    f"SELECT delay_bucket, n, {PCT_SQL.format(n='n', t='SUM(n) OVER ()')} AS pct FROM "
    f"(SELECT {BUCKET_SQL} AS delay_bucket, COUNT(*) AS n FROM clean GROUP BY 1) ORDER BY n DESC", "clean"))
def q_bucket_summary(spark, d):
    return R.bucket_summary(clean(spark, d))


@query("delay_rate_overall", with_ctes(
    f"SELECT total, delayed, {PCT_SQL.format(n='delayed', t='total')} AS pct_delayed FROM "
    "(SELECT COUNT(*) AS total, CAST(SUM(CAST(ArrDelay >= 15 AS INT)) AS BIGINT) AS delayed FROM clean)", "clean"))
def q_delay_rate_overall(spark, d):
    return R.delay_rate_overall(clean(spark, d))


def _rate_sql(key: str) -> str:
    return with_ctes(
        f"SELECT {key}, n, delayed, {PCT_SQL.format(n='delayed', t='n')} AS pct_delayed FROM "
        f"(SELECT {key}, COUNT(*) AS n, CAST(SUM(CAST(ArrDelay >= 15 AS INT)) AS BIGINT) AS delayed "
        f"FROM clean GROUP BY {key}) ORDER BY pct_delayed DESC", "clean")


@query("delay_rate_by_month", _rate_sql("Month"))
def q_delay_rate_by_month(spark, d):
    return R.rate_by(clean(spark, d), ["Month"])


@query("delay_rate_by_dow", _rate_sql("DayOfWeek"))
def q_delay_rate_by_dow(spark, d):
    return R.rate_by(clean(spark, d), ["DayOfWeek"])


@query("delay_rate_grouping_sets", with_ctes(
    "SELECT Month, DayOfWeek, n, delayed, CASE WHEN g = 3 THEN 'overall' WHEN g = 1 THEN 'Month' "
    f"ELSE 'DayOfWeek' END AS level, {PCT_SQL.format(n='delayed', t='n')} AS pct_delayed FROM "
    "(SELECT Month, DayOfWeek, GROUPING(Month, DayOfWeek) AS g, COUNT(*) AS n, "
    "CAST(SUM(CAST(ArrDelay >= 15 AS INT)) AS BIGINT) AS delayed FROM clean "
    "GROUP BY GROUPING SETS ((), (Month), (DayOfWeek)))", "clean"))
def q_delay_rate_grouping_sets(spark, d):
    return R.rate_grouping_sets(clean(spark, d), ["Month", "DayOfWeek"])


@query("topk_months", with_ctes(
    f"SELECT Month, n, delayed, {PCT_SQL.format(n='delayed', t='n')} AS pct_delayed FROM "
    "(SELECT Month, COUNT(*) AS n, CAST(SUM(CAST(ArrDelay >= 15 AS INT)) AS BIGINT) AS delayed "
    "FROM clean GROUP BY Month) ORDER BY pct_delayed DESC, Month LIMIT 6", "clean"))
def q_topk_months(spark, d):
    return R.top_by_rate(clean(spark, d), "Month", 6)


def _missing_sql() -> str:
    types = {"Year": "i", "Month": "i", "DayofMonth": "i", "DayOfWeek": "i", "DepTime": "i", "CRSDepTime": "i",
             "ArrTime": "i", "CRSArrTime": "i", "DepDelay": "d", "Distance": "d", "Cancelled": "i", "TaxiIn": "d",
             "TaxiOut": "d", "ArrDelay": "d"}
    parts = []
    for c, t in types.items():
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if t == "d" else "")
        parts.append(f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {cond}) AS n_missing, "
                     f"{PCT_SQL.format(n=f'COUNT(*) FILTER (WHERE {cond})', t='COUNT(*)')} AS pct_missing "
                     "FROM raw_features")
    return with_ctes(" UNION ALL ".join(parts), "raw_features")


@query("missing_report", _missing_sql())
def q_missing_report(spark, d):
    return P.missing_report(raw_features(spark, d))


def _five_sql(cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", MIN({c}) AS min, "
             f"CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS q50, "
             f"CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q75, MAX({c}) AS max FROM features" for c in cols]
    return with_ctes(" UNION ALL ".join(parts), "features")


@query("five_number_summary", _five_sql(SUMMARY_COLS))
def q_five_number_summary(spark, d):
    return P.five_number_summary(features(spark, d), SUMMARY_COLS)


def _describe_sql(cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, round(AVG({c}), 6) AS mean, "
             f"round(STDDEV_SAMP({c}), 6) AS std, MIN({c}) AS min, "
             f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
             f"round(quantile_cont({c}, 0.75), 6) AS q75, MAX({c}) AS max FROM features" for c in cols]
    return with_ctes(" UNION ALL ".join(parts), "features")


@query("describe_columns", _describe_sql(["ArrDelay", "DepDelay", "Distance"]))
def q_describe_columns(spark, d):
    out = P.describe_columns(features(spark, d), ["ArrDelay", "DepDelay", "Distance"])
    return out.select("column", "count", r6("mean").alias("mean"), r6("std").alias("std"), "min",
                      r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"), "max")


CORR_COLS = ["Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime", "DepDelay",
             "Distance", "TaxiIn", "TaxiOut", "ArrDelay", "DepHour", "ArrHour"]


def _corr_sql() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            parts.append(f"SELECT '{a}' AS col_x, '{b}' AS col_y, "
                         f"round(covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})), 6) AS r FROM cc")
    cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in CORR_COLS)
    body = " UNION ALL ".join(parts)
    return with_ctes(body, "transformed", extra=f"cc AS (SELECT * FROM transformed WHERE {cond})")


@query("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, d):
    df = C.drop_and_rename(transformed(spark, d), drop=["Year", "Cancelled"])
    return P.correlation_matrix(df, CORR_COLS).select("col_x", "col_y", r6("r").alias("r"))


PAIR_COLS = ["DepTime", "DepDelay", "Distance", "ArrDelay"]


@query("correlation_pairwise", with_ctes(" UNION ALL ".join(
    f"SELECT '{a}' AS col_x, '{b}' AS col_y, COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    f"round(corr({a}, {b}), 6) AS r FROM raw_features"
    for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]), "raw_features"))
def q_correlation_pairwise(spark, d):
    out = P.correlation_pairwise(raw_features(spark, d), PAIR_COLS)
    return out.select("col_x", "col_y", "n", r6("r").alias("r"))


@query("correlation_pairwise_features", with_ctes(" UNION ALL ".join(
    f"SELECT '{a}' AS col_x, '{b}' AS col_y, COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    f"round(CASE WHEN isfinite(corr({a}, {b})) THEN corr({a}, {b}) END, 6) AS r FROM fl_typed"
    for i, a in enumerate(FEATURE_COLUMNS) for b in FEATURE_COLUMNS[i + 1:]), "fl_typed"))
def q_correlation_pairwise_features(spark, d):
    """All pairs of the 14 feature columns as read, each over the rows where both are there."""
    out = P.correlation_pairwise(raw_features(spark, d), FEATURE_COLUMNS)
    return out.select("col_x", "col_y", "n", r6("r").alias("r"))


def _clip_ctes(cols: list[str]) -> str:
    return ", ".join(
        f"b_{c} AS (SELECT quantile_cont({c}, 0.01) AS lo, quantile_cont({c}, 0.99) AS hi FROM features), "
        f"k_{c} AS (SELECT least(greatest({c}, lo), hi) AS v FROM features, b_{c} WHERE {c} IS NOT NULL)" for c in cols)


def _hist_sql(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", CAST(r.bin AS INT) AS bin, round(m.lo + (r.bin - 1) * w, 6) AS lo, "
            f"round(m.lo + r.bin * w, 6) AS hi, coalesce(n, 0) AS n FROM range(1, 81) r(bin), "
            f"(SELECT MIN(v) AS lo, (MAX(v) - MIN(v)) / 80 AS w FROM k_{c}) m LEFT JOIN ("
            f"SELECT least(CAST(floor(CAST(80 AS DOUBLE) * (v - lo) / (hi - lo)) AS BIGINT) + 1, 80) AS bin, COUNT(*) AS n "
            f"FROM k_{c}, (SELECT MIN(v) AS lo, MAX(v) AS hi FROM k_{c}) GROUP BY 1) h ON h.bin = r.bin")


def _clipped(spark, d, build):
    """A report of the three plotted columns from their clipped value counts; the source is read once."""
    vc = Q.value_counts(features(spark, d), QUANTILE_COLS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = P.clipped_counts(features(spark, d), QUANTILE_COLS, 0.01, 0.99, vc=vc)
        out = build(counts)
        return spark.createDataFrame(out.collect(), out.schema)  # columns x bins or grid points
    finally:
        vc.unpersist()


@query("histogram_80", with_ctes(" UNION ALL ".join(map(_hist_sql, QUANTILE_COLS)), "features",
                                 extra=_clip_ctes(QUANTILE_COLS)))
def q_histogram_80(spark, d):
    h = _clipped(spark, d, lambda counts: P.histograms(counts, QUANTILE_COLS, bins=80))
    return h.select("column", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


def _kde_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", CAST(gi AS INT) AS gi, round(g0 + gi * step, 6) AS x, "
        "round(SUM(c * exp(-0.5 * ((g0 + gi * step - v) / h) * ((g0 + gi * step - v) / h))) * norm, 9) AS density "
        f"FROM (SELECT v, COUNT(*) AS c FROM k_{c} GROUP BY v) vc, "
        "(SELECT h, lo - 3 * h AS g0, (hi + 3 * h - (lo - 3 * h)) / 199 AS step, "
        "1.0 / (n * h * sqrt(2 * pi())) AS norm FROM "
        "(SELECT COUNT(*) AS n, MIN(v) AS lo, MAX(v) AS hi, STDDEV_SAMP(v) * pow(COUNT(*), -0.2) AS h "
        f"FROM k_{c})) p, range(200) r(gi) GROUP BY gi, g0, step, norm")


@query("kde_grid", with_ctes(" UNION ALL ".join(map(_kde_sql, QUANTILE_COLS)), "features",
                             extra=_clip_ctes(QUANTILE_COLS)))
def q_kde_grid(spark, d):
    k = _clipped(spark, d, lambda counts: P.densities(counts, QUANTILE_COLS, gridsize=200))
    return k.select("column", "gi", r6("x").alias("x"), F.round("density", 9).alias("density"))


def _kde_continuous_sql() -> str:
    return (_kde_sql("price").replace("k_price", "prices")
            .replace(", 6) AS x", ", 4) AS x").replace(", 9) AS density", ", 9) AS density"))


@query("kde_continuous", f"WITH prices AS (SELECT l_extendedprice AS v FROM lineitem) {_kde_continuous_sql()}")
def q_kde_continuous(spark, d):
    """Density of a continuous column by linear binning: weights on an even grid instead of its distinct values."""
    rows = read_table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("price"))
    k = P.densities_binned(rows, ["price"], gridsize=200)
    return k.select("column", "gi", r6("x", 4).alias("x"), F.round("density", 9).alias("density"))


# ---------------------------------------------------------------- sampling and splitting

@query("sample_third", with_ctes(
    f"SELECT * FROM clean ORDER BY {HASH_KEY}, l_orderkey, l_linenumber, "
    + ", ".join(f"{c} NULLS FIRST" for c in ["Year", "Month", "DayofMonth", "DayOfWeek", "DepTime"])
    + " LIMIT (SELECT CAST(ceil(COUNT(*) / 3.0) AS BIGINT) FROM clean)", "clean"))
def q_sample_third(spark, d):
    """A third of the rows, exactly: kept where they lie, ranked only at the bound."""
    return S.sample_or_limit(clean(spark, d), fraction=1 / 3, max_rows=1 << 62, keys=KEYS)


@query("hash_sample", with_ctes(f"SELECT * FROM clean WHERE {HASH_KEY} < {TEST_BOUND}", "clean"))
def q_hash_sample(spark, d):
    return S.hash_sample(clean(spark, d), 0.2, KEYS)


@query("hash_split", with_ctes(
    f"SELECT l_orderkey, l_linenumber, ArrDelay, CASE WHEN {HASH_KEY} < {TEST_BOUND} THEN 'test' ELSE 'train' END "
    "AS split FROM clean", "clean"))
def q_hash_split(spark, d):
    return S.split_labelled(clean(spark, d), 0.2, KEYS).select(*KEYS, "ArrDelay", "split")


@query("sample_exact_n", with_ctes(
    f"SELECT * FROM clean ORDER BY {HASH_KEY}, "
    + ", ".join(f"{c} NULLS FIRST" for c in ["Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime",
                                            "ArrTime", "CRSArrTime", "DepDelay", "ArrDelay", "Distance", "Cancelled",
                                            "TaxiIn", "TaxiOut", "UniqueCarrier", "Origin", "l_orderkey",
                                            "l_linenumber"])
    + " LIMIT 3000", "clean"))
def q_sample_exact_n(spark, d):
    return S.sample_exact_n(clean(spark, d), 3000, KEYS)


NULL_HASH = null_safe_hash("DepTime")


@query("hash_split_null_keys", with_ctes(
    f"SELECT split, COUNT(*) AS n, COUNT(*) FILTER (WHERE DepTime IS NULL) AS null_keys FROM (SELECT DepTime, "
    f"CASE WHEN {NULL_HASH} < {TEST_BOUND} THEN 'test' ELSE 'train' END AS split FROM raw_features) GROUP BY split",
    "raw_features"))
def q_hash_split_null_keys(spark, d):
    """The split by a key that may be null: both halves together are all rows."""
    train, test = S.hash_split(raw_features(spark, d), 0.2, ["DepTime"])
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("DepTime").isNull()).alias("null_keys"))


@query("sample_exact_n_null_keys", with_ctes(
    f"SELECT * FROM raw_features ORDER BY {NULL_HASH}, "
    + ", ".join(f"{c} NULLS FIRST" for c in FEATURE_COLUMNS) + " LIMIT 3000", "raw_features"))
def q_sample_exact_n_null_keys(spark, d):
    return S.sample_exact_n(raw_features(spark, d), 3000, ["DepTime"])


@query("bernoulli_sample", with_ctes("SELECT COUNT(*) AS n_rows, 0 AS not_in_source, TRUE AS near FROM clean", "clean"))
def q_bernoulli_sample(spark, d):
    """A seeded 2 % sample, checked: no row more often than in the source, size within six standard deviations."""
    source, fraction = clean(spark, d), 0.02
    sample = S.bernoulli_sample(source, fraction, seed=42)
    n, taken = source.count(), sample.count()
    extra = sample.exceptAll(source).count()
    near = abs(taken - fraction * n) <= 6 * (n * fraction * (1 - fraction)) ** 0.5
    return spark.createDataFrame([(n, extra, near)], "n_rows bigint, not_in_source int, near boolean")


@query("random_split_counts", with_ctes("SELECT COUNT(*) AS total, 0 AS lost, TRUE AS near FROM clean", "clean"))
def q_random_split_counts(spark, d):
    """``randomSplit`` halves, checked: together all rows once, sizes within six standard deviations."""
    source = clean(spark, d)
    train, test = S.random_split(source, [0.8, 0.2], seed=42)
    # Copies of each row in the source and in either half: one shuffle, and one pass over each of the three.
    sides = ["source", "train", "test"]
    rows = [df.select(F.struct(*df.columns).alias("row"), *[F.lit(int(s == t)).alias(t) for t in sides])
            for s, df in zip(sides, (source, train, test), strict=True)]
    copies = rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("row").agg(*[F.sum(s).alias(s) for s in sides])
    lost = F.greatest(F.col("source") - F.col("train") - F.col("test"), F.lit(0))
    sums = copies.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(s) for s, x in zip([*sides, "lost"], [*sides, lost], strict=True)]).first()
    n, n_test = sums["source"], sums["test"]
    near = abs(n_test - 0.2 * n) <= 6 * (n * 0.16) ** 0.5
    return spark.createDataFrame([(sums["train"] + n_test, sums["lost"], near)], "total bigint, lost int, near boolean")


@query("sample_escalate", with_ctes(
    f"SELECT * FROM clean ORDER BY {HASH_KEY}, "
    + ", ".join(f"{c} NULLS FIRST" for c in ["Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime",
                                            "ArrTime", "CRSArrTime", "DepDelay", "ArrDelay", "Distance", "Cancelled",
                                            "TaxiIn", "TaxiOut", "UniqueCarrier", "Origin", "l_orderkey",
                                            "l_linenumber"])
    + " LIMIT (SELECT least(3000, CAST(ceil(0.0005 * COUNT(*)) AS BIGINT)) FROM clean)", "clean"))
def q_sample_escalate(spark, d):
    return S.sample_or_limit(clean(spark, d), fraction=0.0005, max_rows=3000, keys=KEYS)


CLEAN_COLS = ["Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
              "DepDelay", "ArrDelay", "Distance", "Cancelled", "TaxiIn", "TaxiOut", "UniqueCarrier", "Origin"]


@query("limit_preview", with_ctes(
    "SELECT * FROM clean ORDER BY l_orderkey, l_linenumber, "
    + ", ".join(f"{c} NULLS FIRST" for c in CLEAN_COLS) + " LIMIT 5", "clean"))
def q_limit_preview(spark, d):
    """``SELECT * ... LIMIT 5`` preview (S6, O2), ordered by key and then every
    column so it is reproducible; planned as a top-k."""
    return clean(spark, d).orderBy(*KEYS, *CLEAN_COLS).limit(5)


# ---------------------------------------------------------------- features and models

IMPUTE_COLS = ["ArrTime", "DepDelay", "DepTime", "Distance", "TaxiIn", "TaxiOut"]


@query("impute_mean", with_ctes(
    "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round(coalesce({c}, AVG({c}) OVER ()), 6) AS {c}" for c in IMPUTE_COLS)
    + " FROM (SELECT l_orderkey, l_linenumber, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in IMPUTE_COLS)
    + " FROM fl_typed)", "fl_typed"))
def q_impute_mean(spark, d):
    raw = C.cast_columns(fl(spark, d), {c: "double" for c in IMPUTE_COLS})
    imp = M.impute_mean(raw.select(*KEYS, *IMPUTE_COLS, "ArrDelay"), IMPUTE_COLS + ["ArrDelay"])
    return imp.df.select(*KEYS, *[r6(c).alias(c) for c in IMPUTE_COLS])


SCALE_COLS = ["DepDelay", "Distance", "TaxiIn", "TaxiOut"]


@query("standard_scale", with_ctes(
    "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round(({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER (), 6) AS z_{c}" for c in SCALE_COLS)
    + " FROM (SELECT l_orderkey, l_linenumber, " + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in SCALE_COLS)
    + " FROM clean)", "clean"))
def q_standard_scale(spark, d):
    df = C.cast_columns(clean(spark, d), {c: "double" for c in SCALE_COLS}).select(*KEYS, *SCALE_COLS)
    scaled, _ = M.standard_scale(df, SCALE_COLS)
    out = M.unpack_vector(scaled, "scaled_features", SCALE_COLS, prefix="z_")
    return out.select(*KEYS, *[r6(f"z_{c}").alias(f"z_{c}") for c in SCALE_COLS])


# The columns of the scaled vector, label left out.
STAGE5_COLS = ["DepDelay", "Distance", "TaxiIn", "TaxiOut", "DepTime", "ArrTime", "DepHour", "ArrHour", "DayOfWeek"]


@query("transform_impute_scale", with_ctes(
    "SELECT Month, DayofMonth, " + ", ".join(
        f"round(({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER (), 6) AS z_{c}" for c in STAGE5_COLS)
    + " FROM filled", "transformed", extra="filled AS (SELECT Month, DayofMonth, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), AVG({c}) OVER ()) AS {c}" for c in STAGE5_COLS) + " FROM transformed)"))
def q_transform_impute_scale(spark, d):
    """Stage 5 in one chain: doubles, hours, mean imputation, nine columns assembled and standardised.

    The label is neither imputed nor scaled (no leak of the target); hours are
    imputed like the other columns, so no row is skipped.
    """
    rows = written(transformed(spark, d).select("Month", "DayofMonth", *STAGE5_COLS), "transformed")  # three passes follow
    imputed = M.impute_mean(rows, STAGE5_COLS).df
    scaled, _ = M.standard_scale(imputed.select("Month", "DayofMonth", *STAGE5_COLS), STAGE5_COLS)
    out = M.unpack_vector(scaled, "scaled_features", STAGE5_COLS, prefix="z_")
    return out.select("Month", "DayofMonth", *[quick_round(f"z_{c}").alias(f"z_{c}") for c in STAGE5_COLS])


@query("scale_train_apply_test", with_ctes(
    "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round(({c} - (SELECT AVG({c}) FROM tr)) / (SELECT STDDEV_SAMP({c}) FROM tr), 6) AS z_{c}"
        for c in SCALE_COLS) + " FROM te", "clean",
    extra="typed AS (SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in SCALE_COLS)
    + f" FROM clean), tr AS (SELECT * FROM typed WHERE {HASH_KEY} >= {TEST_BOUND}), "
    f"te AS (SELECT * FROM typed WHERE {HASH_KEY} < {TEST_BOUND})"))
def q_scale_train_apply_test(spark, d):
    df = C.cast_columns(clean(spark, d), {c: "double" for c in SCALE_COLS}).select(*KEYS, *SCALE_COLS)
    train, test = S.hash_split(df, 0.2, KEYS)
    scaled, _ = M.standard_scale(test, SCALE_COLS, fit_on=train)
    out = M.unpack_vector(scaled, "scaled_features", SCALE_COLS, prefix="z_")
    return out.select(*KEYS, *[r6(f"z_{c}").alias(f"z_{c}") for c in SCALE_COLS])


@query("model_input", with_ctes(
    "SELECT * FROM (SELECT TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, TRY_CAST(Distance AS DOUBLE) AS Distance, "
    "TRY_CAST(TaxiIn AS DOUBLE) AS TaxiIn, TRY_CAST(TaxiOut AS DOUBLE) AS TaxiOut, "
    "CAST(trunc(TRY_CAST(DepTime AS DOUBLE) / 100) AS INT) AS DepHour, "
    "CAST(trunc(TRY_CAST(ArrTime AS DOUBLE) / 100) AS INT) AS ArrHour, DayOfWeek, Month, ArrDelay "
    "FROM clean WHERE Cancelled = 0) WHERE DepDelay IS NOT NULL AND Distance IS NOT NULL AND TaxiIn IS NOT NULL "
    "AND TaxiOut IS NOT NULL AND DepHour IS NOT NULL AND ArrHour IS NOT NULL AND DayOfWeek IS NOT NULL "
    "AND Month IS NOT NULL AND ArrDelay IS NOT NULL", "clean"))
def q_model_input(spark, d):
    return M.model_input(clean(spark, d), assemble=False)


@query("ridge_one_feature", with_ctes(
    "SELECT round(b, 6) AS coefficient, round(my - b * mx, 6) AS intercept FROM ("
    "SELECT (covar_pop(DepDelay, ArrDelay) / var_pop(DepDelay)) / (1 + 0.1 / stddev_pop(ArrDelay)) AS b, "
    "AVG(DepDelay) AS mx, AVG(ArrDelay) AS my FROM tr)", "clean",
    extra="tr AS (SELECT TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, ArrDelay FROM clean "
    f"WHERE Cancelled = 0 AND TRY_CAST(DepDelay AS DOUBLE) IS NOT NULL AND {HASH_KEY} >= {TEST_BOUND})"))
def q_ridge_one_feature(spark, d):
    """One-feature ridge (regParam 0.1) on the hash-train split vs. its closed form.

    With standardisation Spark's normal solver minimises the squared error of
    the standardised problem plus (lambda / std_pop(y)) * w^2 / 2, so the slope
    is the OLS slope shrunk by 1 / (1 + lambda / std_pop(y)).
    """
    df = C.cast_columns(clean(spark, d), {"DepDelay": "double"})
    df = C.not_cancelled(df).select(*KEYS, "DepDelay", "ArrDelay").dropna()
    train, _ = S.hash_split(df, 0.2, KEYS)
    model = M.linear_regression(["DepDelay"], reg_param=0.1, solver="normal").fit(train)
    lr = model.stages[-1]
    # A fitted model is a few driver-side numbers; return them as a one-row frame.
    return spark.createDataFrame([(float(lr.coefficients[0]), float(lr.intercept))],
                                 "coefficient double, intercept double").select(
        r6("coefficient").alias("coefficient"), r6("intercept").alias("intercept"))


@query("regression_metrics", with_ctes(
    "SELECT COUNT(*) AS n, round(sqrt(SUM((p - y) * (p - y)) / COUNT(*)), 6) AS rmse, "
    "round(1 - SUM((p - y) * (p - y)) / (var_pop(y) * COUNT(*)), 6) AS r2, round(AVG(abs(p - y)), 6) AS mae "
    "FROM (SELECT ArrDelay AS y, DepDelay * 1.0 + 5.0 AS p FROM features "
    "WHERE DepDelay IS NOT NULL)", "features"))
def q_regression_metrics(spark, d):
    """RMSE/R2/MAE of the rule ``ArrDelay ~ DepDelay + 5`` in one aggregate."""
    df = features(spark, d).filter(F.col("DepDelay").isNotNull())
    pred = df.withColumn("prediction", F.col("DepDelay") * F.lit(1.0) + F.lit(5.0))
    m = M.regression_metrics(pred)
    return m.select("n", r6("rmse").alias("rmse"), r6("r2").alias("r2"), r6("mae").alias("mae"))


def _train_test(spark, d):
    f = C.typed_features(clean(spark, d), keep_extra=KEYS).df
    f = C.not_cancelled(f)
    f = M.add_hours(C.cast_columns(f, {"DepTime": "double", "ArrTime": "double"}))
    f = f.select(*KEYS, *MODEL_FEATURES, LABEL)
    # Every model query counts, lays out, fits and scores: the view is typed, filtered and hashed once for all passes.
    # Incomplete rows are left out as the files are read: ahead of the write, the filter would be pushed below the
    # casts and type every column a second time.
    train, test = S.hash_split_written(f, 0.2, KEYS)
    return train.dropna(), test.dropna()


def _fit(pipeline, train):
    """Fit on a train set: a forest on its layout, a linear model on its rows as written."""
    return M.fit_persisted(pipeline, train)


# Rows that reach the models, split by the same key hash; and the label's range in either half.
MODEL_CTES = ("mi AS (SELECT *, CASE WHEN {h} < {b} THEN 'test' ELSE 'train' END AS part FROM (SELECT l_orderkey, l_linenumber, "
              "TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, TRY_CAST(DepTime AS INT) AS DepTime, TRY_CAST(ArrTime AS INT) AS ArrTime, "
              "ArrDelay FROM clean WHERE Cancelled = 0) WHERE DepDelay IS NOT NULL AND DepTime IS NOT NULL "
              "AND ArrTime IS NOT NULL)").format(h=HASH_KEY, b=TEST_BOUND)
# Rows that reach the models, with all eight features.
MODEL_FEATURE_CTE = (
    "mx AS (SELECT * FROM (SELECT l_orderkey, l_linenumber, TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, "
    "CAST(Distance AS DOUBLE) AS Distance, CAST(TaxiIn AS DOUBLE) AS TaxiIn, CAST(TaxiOut AS DOUBLE) AS TaxiOut, "
    "CAST(trunc(TRY_CAST(DepTime AS DOUBLE) / 100) AS DOUBLE) AS DepHour, CAST(trunc(TRY_CAST(ArrTime AS DOUBLE) / 100) AS DOUBLE) "
    "AS ArrHour, CAST(DayOfWeek AS DOUBLE) AS DayOfWeek, CAST(Month AS DOUBLE) AS Month, ArrDelay FROM clean WHERE Cancelled = 0) "
    "WHERE DepDelay IS NOT NULL AND DepHour IS NOT NULL AND ArrHour IS NOT NULL)")
N_TEST = "(SELECT COUNT(*) FROM mi WHERE part = 'test')"
# Least squares of the label on DepDelay alone over the train rows.
OLS_CTE = (", ols AS (SELECT regr_slope(ArrDelay, DepDelay) AS b, regr_intercept(ArrDelay, DepDelay) AS a "
           "FROM mi WHERE part = 'train')")
RIDGE_CTE = (", ols AS (SELECT b, my - b * mx AS a FROM (SELECT (covar_pop(DepDelay, ArrDelay) / var_pop(DepDelay)) "
             "/ (1 + 0.1 / stddev_pop(ArrDelay)) AS b, AVG(DepDelay) AS mx, AVG(ArrDelay) AS my FROM mi WHERE part = 'train'))")
METRICS_SQL = ("SELECT COUNT(*) AS n, round(sqrt(AVG((p - y) * (p - y))), 6) AS rmse, "
               "round(1 - SUM((p - y) * (p - y)) / (var_pop(y) * COUNT(*)), 6) AS r2, round(AVG(abs(p - y)), 6) AS mae "
               "FROM (SELECT ArrDelay AS y, a + b * DepDelay AS p FROM mi, ols WHERE part = 'test')")


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({c: r6(c) for c in ("rmse", "r2", "mae")})


@query("linear_regression_one_feature", with_ctes(METRICS_SQL, "clean", extra=MODEL_CTES + RIDGE_CTE))
def q_linear_regression_one_feature(spark, d):
    """The regression of stage 6 on one feature, whose solution has a closed form."""
    train, test = _train_test(spark, d)
    model = _fit(M.linear_regression(["DepDelay"], max_iter=50, reg_param=0.1, solver="normal"), train)
    return _rounded(M.regression_metrics(model.transform(test)))


@query("linear_regression", with_ctes(
    f"SELECT {N_TEST} AS n, TRUE AS better_than_one_feature, TRUE AS r2_positive", "clean", extra=MODEL_CTES))
def q_linear_regression(spark, d):
    """Eight features, maxIter 50, regParam 0.1: rows scored, and that the fit beats one feature's on the train rows."""
    train, test = _train_test(spark, d)
    with M.laid_out(train) as rows:
        full = M.linear_regression(MODEL_FEATURES, max_iter=50, reg_param=0.1).fit(rows)
        one = M.linear_regression(["DepDelay"], max_iter=50, reg_param=0.1).fit(rows)
        rmse = {r["model"]: r["rmse"] for r in M.compare_models({"full": full, "one": one}, rows).collect()}
    m = M.regression_metrics(full.transform(test))
    return m.select("n", F.lit(rmse["full"] <= rmse["one"] + 1e-6).alias("better_than_one_feature"),
                    (F.col("r2") > 0).alias("r2_positive"))


def _splits_sql(features: list[str], train_rows: bool = True) -> str:
    """Every threshold between two neighbouring values, by prefix sums over each feature's values."""
    train = f"tr AS (SELECT * FROM mx WHERE {HASH_KEY} >= {TEST_BOUND}), " if train_rows else ""
    values = " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, {c} AS v, COUNT(*) AS n, SUM({LABEL}) AS s FROM tr GROUP BY {c}"
                                for i, c in enumerate(features))
    return (f"{train}vals AS ({values}), "
            "sums AS (SELECT *, SUM(n) OVER w AS nl, SUM(s) OVER w AS sl, SUM(n) OVER (PARTITION BY i) AS na, "
            "SUM(s) OVER (PARTITION BY i) AS sa, lead(v) OVER w AS nxt FROM vals WINDOW w AS (PARTITION BY i ORDER BY v)), "
            "splits AS (SELECT i, feature, (v + nxt) / 2 AS threshold, CAST(nl AS BIGINT) AS n_left, CAST(na - nl AS BIGINT) AS n_right, "
            "sl / nl AS mean_left, (sa - sl) / (na - nl) AS mean_right, "
            "(sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na) / na AS gain FROM sums WHERE nxt IS NOT NULL)")


def _ridge_ctes(features: list[str], reg: float) -> str:
    """Ridge weights of several features: the standardised normal equations, solved by elimination in a recursive query."""
    p = len(features)
    r = lambda a, b: f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))"
    system = "[" + ", ".join("[" + ", ".join([r(a, b) + (f" + {reg} / stddev_pop({LABEL})" if a == b else "") for b in features]
                                             + [r(a, LABEL)]) + "]" for a in features) + "]"
    weights = ", ".join(f"m[{i + 1}][{p + 1}] * sy / sd[{i + 1}]" for i in range(p))
    return (f"tr AS (SELECT * FROM mx WHERE {HASH_KEY} >= {TEST_BOUND}), moments AS (SELECT [{', '.join(f'AVG({c})' for c in features)}] AS mean, "
            f"[{', '.join(f'stddev_pop({c})' for c in features)}] AS sd, AVG({LABEL}) AS my, stddev_pop({LABEL}) AS sy, {system} AS m FROM tr), "
            "solved(k, m) AS (SELECT 0, m FROM moments UNION ALL SELECT k + 1, list_transform(m, lambda line, i: CASE WHEN i = k + 1 "
            "THEN list_transform(line, lambda e: e / m[k + 1][k + 1]) ELSE list_transform(list_zip(line, m[k + 1]), "
            f"lambda e: e[1] - e[2] * line[k + 1] / m[k + 1][k + 1]) END) FROM solved WHERE k < {p}), "
            f"ridge AS (SELECT w, my - list_dot_product(w, mean) AS b FROM (SELECT [{weights}] AS w, mean, my "
            f"FROM (SELECT m FROM solved WHERE k = {p}), (SELECT mean, sd, my, sy FROM moments)))")


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("linear_regression_weights", _recursive(with_ctes(" UNION ALL ".join(
    [f"SELECT '{c}' AS component, round(w[{i + 1}], 6) AS weight FROM ridge" for i, c in enumerate(MODEL_FEATURES)]
    + ["SELECT 'intercept' AS component, round(b, 6) AS weight FROM ridge"]), "clean",
    extra=MODEL_FEATURE_CTE + ", " + _ridge_ctes(MODEL_FEATURES, 0.1))))
def q_linear_regression_weights(spark, d):
    """Weights of the eight-feature regression of stage 6 (maxIter 50, regParam 0.1) against its normal equations (M5)."""
    train, _ = _train_test(spark, d)
    lr = _fit(M.linear_regression(MODEL_FEATURES, max_iter=50, reg_param=0.1), train).stages[-1]
    rows = [*zip(MODEL_FEATURES, map(float, lr.coefficients), strict=True), ("intercept", float(lr.intercept))]
    return spark.createDataFrame(rows, "component string, weight double").withColumn("weight", r6("weight"))


_PREDICTED = ("SELECT '{m}' AS model, COUNT(*) AS n, round(sqrt(AVG((p - {y}) * (p - {y}))), 6) AS rmse, "
              "round(1 - SUM((p - {y}) * (p - {y})) / (var_pop({y}) * COUNT(*)), 6) AS r2, round(AVG(abs(p - {y})), 6) AS mae FROM ({q})")
_TEST_ROWS = f"FROM mx, {{t}} WHERE {HASH_KEY} < {TEST_BOUND}"


@query("model_comparison_exact", _recursive(with_ctes(" UNION ALL ".join([
    _PREDICTED.format(m="linear_regression", y=LABEL, q=f"SELECT {LABEL}, b + list_dot_product(w, [{', '.join(MODEL_FEATURES)}]) AS p "
                      + _TEST_ROWS.format(t="ridge")),
    _PREDICTED.format(m="stump", y=LABEL, q=f"SELECT {LABEL}, CASE WHEN DepDelay <= threshold THEN mean_left ELSE mean_right END AS p "
                      + _TEST_ROWS.format(t="(SELECT * FROM splits WHERE feature = 'DepDelay' ORDER BY gain DESC, threshold LIMIT 1)"))]),
    "clean", extra=MODEL_FEATURE_CTE + ", " + _ridge_ctes(MODEL_FEATURES, 0.1) + ", "
    + _splits_sql(["DepDelay"], train_rows=False))))
def q_model_comparison_exact(spark, d):
    """RMSE, R2 and MAE on the test rows of two models whose fits have a closed form (M10, O12): all eight features, and one split."""
    train, test = _train_test(spark, d)
    stump = M.random_forest(["DepDelay"], num_trees=1, max_depth=1, max_bins=256, bagging=False)
    # Only what the stump looks at is laid out and cached; the keys deal its rows evenly.
    models = {"linear_regression": _fit(M.linear_regression(MODEL_FEATURES, max_iter=50, reg_param=0.1), train),
              "stump": _fit(stump, train.select(*KEYS, "DepDelay", LABEL))}
    return _rounded(M.compare_models(models, test))


def _forest_checks(pred: DataFrame, train: DataFrame) -> DataFrame:
    """Rows scored; a forest's prediction is an average of train labels, so it lies in their range."""
    low, high = train.agg(F.min(LABEL), F.max(LABEL)).first()
    return pred.agg(F.count(F.lit(1)).alias("n"), F.min(F.col("prediction").between(low, high)).alias("in_label_range"))


@query("random_forest", with_ctes(f"SELECT {N_TEST} AS n, TRUE AS in_label_range", "clean", extra=MODEL_CTES))
def q_random_forest(spark, d):
    """50 trees of depth 8, seed 42."""
    train, test = _train_test(spark, d)
    with M.laid_out(train) as rows:
        return _forest_checks(M.random_forest(MODEL_FEATURES).fit(rows).transform(test), rows)


ROUNDED_SPLIT = "round(threshold, 6) AS threshold, round(mean_left, 6) AS mean_left, round(mean_right, 6) AS mean_right"


@query("best_splits", with_ctes(
    f"SELECT feature, n_left, n_right, {ROUNDED_SPLIT}, round(gain, 6) AS gain FROM splits "
    "QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) = 1", "clean",
    extra=MODEL_FEATURE_CTE + ", " + _splits_sql(MODEL_FEATURES)))
def q_best_splits(spark, d):
    """The split of each model feature that lowers the label's variance most (M6)."""
    train, _ = _train_test(spark, d)
    out = L.best_splits(train, MODEL_FEATURES, LABEL)
    return out.withColumns({c: r6(c) for c in ("threshold", "mean_left", "mean_right", "gain")})


# Features of few values, all of whose thresholds a forest of 256 bins looks at.
STUMP_FEATURES = ["DepDelay", "TaxiIn", "TaxiOut", "DepHour", "ArrHour", "DayOfWeek", "Month"]


@query("forest_stump", with_ctes(
    f"SELECT feature, {ROUNDED_SPLIT} FROM splits ORDER BY gain DESC, i, splits.threshold LIMIT 1", "clean",
    extra=MODEL_FEATURE_CTE + ", " + _splits_sql(STUMP_FEATURES)))
def q_forest_stump(spark, d):
    """A forest of one tree of depth 1 without bagging learns the best split of all (M6)."""
    train, _ = _train_test(spark, d)
    model = _fit(M.random_forest(STUMP_FEATURES, num_trees=1, max_depth=1, max_bins=256, subset="all", bagging=False), train)
    s = L.fitted_stump(model, STUMP_FEATURES)
    out = spark.createDataFrame([(s.feature, s.threshold, s.mean_left, s.mean_right)],
                                "feature string, threshold double, mean_left double, mean_right double")
    return out.withColumns({c: r6(c) for c in ("threshold", "mean_left", "mean_right")})


@query("iterative_linear", with_ctes(METRICS_SQL.replace(", 6)", ", 3)"), "clean", extra=MODEL_CTES + OLS_CTE))
def q_iterative_linear(spark, d):
    """The iterative fit on one feature against the closed form of least squares (three decimals)."""
    train, test = _train_test(spark, d)
    model = _fit(M.iterative_linear(["DepDelay"], max_iter=100), train)
    return M.regression_metrics(model.transform(test)).withColumns({c: F.round(c, 3) for c in ("rmse", "r2", "mae")})


TRAIN_STEPS = G.Optimiser(rate=0.5)
TRAIN_BATCHES, TRAIN_EPOCHS = 8, 3


def _adam_sql(features: list[str]) -> str:
    """The same training by a recursive query: a step's gradient comes from its batch's matrix of products, not its rows."""
    p, opt = len(features), TRAIN_STEPS
    z = [*(f"z{i}" for i in range(p)), "1.0"]
    gram = "[" + ", ".join("[" + ", ".join(f"SUM({a} * {b})" for b in z) + "]" for a in z) + "]"
    pull = "[" + ", ".join(f"SUM({a} * {LABEL})" for a in z) + "]"
    scaled = ", ".join(f"({c} - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER () AS z{i}" for i, c in enumerate(features))
    zeros = "[" + ", ".join("0.0::DOUBLE" for _ in z) + "]"
    steps = TRAIN_BATCHES * TRAIN_EPOCHS
    blend = lambda old, new, b: f"list_transform(list_zip({old}, {new}), lambda x: {b} * x[1] + {1 - b!r} * x[2])"
    ctes = (f"tr AS (SELECT {LABEL}, {HASH_KEY} % {TRAIN_BATCHES} AS batch, {scaled} FROM mx WHERE {HASH_KEY} >= {TEST_BOUND}), "
            f"products AS (SELECT batch, COUNT(*) AS n, {gram} AS g, {pull} AS c, SUM({LABEL} * {LABEL}) AS yy FROM tr GROUP BY batch), "
            f"run(step, w, m, v, n, loss) AS (SELECT 0, {zeros}, {zeros}, {zeros}, 0::BIGINT, 0.0::DOUBLE UNION ALL "
            f"SELECT step + 1, list_transform(list_zip(w, m2, v2), lambda x: x[1] - {opt.rate} * (x[2] / (1 - pow({opt.beta1}, step + 1))) "
            f"/ (sqrt(x[3] / (1 - pow({opt.beta2}, step + 1))) + {opt.epsilon})), m2, v2, n2, loss2 FROM ("
            f"SELECT step, w, {blend('m', 'slope', opt.beta1)} AS m2, "
            f"{blend('v', 'list_transform(slope, lambda e: e * e)', opt.beta2)} AS v2, n2, loss2 FROM ("
            "SELECT step, w, m, v, p.n AS n2, "
            "(list_dot_product(w, list_transform(p.g, lambda row: list_dot_product(row, w))) - 2 * list_dot_product(w, p.c) + p.yy) / p.n AS loss2, "
            "list_transform(list_zip(list_transform(p.g, lambda row: list_dot_product(row, w)), p.c), lambda x: 2 * (x[1] - x[2]) / p.n) AS slope "
            f"FROM run JOIN products p ON p.batch = step % {TRAIN_BATCHES} WHERE step < {steps})))")
    body = (f"SELECT CAST(step AS INT) AS step, CAST((step - 1) // {TRAIN_BATCHES} + 1 AS INT) AS epoch, n, round(loss, 6) AS loss, "
            + ", ".join(f"round(w[{i + 1}], 6) AS w_{c}" for i, c in enumerate([*features, "intercept"])) + " FROM run WHERE step > 0")
    return with_ctes(body, "clean", extra=MODEL_FEATURE_CTE + ", " + ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def _trace(spark, d, features):
    train, _ = _train_test(spark, d)
    layer = G.train_linear(spark, G.deal_batches(train, features, LABEL, KEYS, TRAIN_BATCHES), TRAIN_EPOCHS, TRAIN_STEPS)
    names = [f"w_{c}" for c in [*features, "intercept"]]
    return layer.trace_frame(spark).select("step", "epoch", "n", r6("loss").alias("loss"),
                                           *[F.round(F.get("weights", F.lit(i)), 6).alias(n) for i, n in enumerate(names)])


@query("gradient_trace", _adam_sql(["DepDelay"]))
def q_gradient_trace(spark, d):
    """Adam on one feature: loss and weights after every step on hash-dealt mini-batches (M9)."""
    return _trace(spark, d, ["DepDelay"])


@query("gradient_trace_features", _adam_sql(MODEL_FEATURES))
def q_gradient_trace_features(spark, d):
    """The same layer over all eight model features (M9)."""
    return _trace(spark, d, MODEL_FEATURES)


def _certificate(gradient: DataFrame) -> DataFrame:
    # + 0.0 turns a rounded -0.0 into 0.
    return gradient.select("component", (F.round("gradient", 6) + F.lit(0.0)).alias("gradient"))


@query("linear_regression_certificate", " UNION ALL ".join(
    f"SELECT '{c}' AS component, CAST(0 AS DOUBLE) AS gradient" for c in [*MODEL_FEATURES, "intercept"]))
def q_linear_regression_certificate(spark, d):
    """Gradient of the penalised loss at the fitted eight-feature regression: zero in every component (M5)."""
    train, _ = _train_test(spark, d)
    lr = _fit(M.linear_regression(MODEL_FEATURES, max_iter=50, reg_param=0.1), train).stages[-1]
    return _certificate(G.squared_loss_gradient(train, MODEL_FEATURES, LABEL, list(lr.coefficients), lr.intercept, 0.1))


@query("delay_classifier_certificate", " UNION ALL ".join(
    f"SELECT '{c}' AS component, CAST(0 AS DOUBLE) AS gradient" for c in [*MODEL_FEATURES, "intercept"]))
def q_delay_classifier_certificate(spark, d):
    """Gradient of the weighted logistic loss at the fitted classifier: zero in every component."""
    train, _ = _train_test(spark, d)
    weighted = M.with_class_weight(train)
    model = _fit(M.delay_classifier(MODEL_FEATURES, max_iter=200, tol=1e-12), weighted).stages[-1]
    return _certificate(G.logistic_loss_gradient(weighted, MODEL_FEATURES, "is_delayed", list(model.coefficients),
                                                 model.intercept, "class_weight"))


@query("score_rows", with_ctes(
    "SELECT l_orderkey, l_linenumber, ArrDelay, round(a + b * DepDelay, 6) AS prediction FROM mi, ols WHERE part = 'test'",
    "clean", extra=MODEL_CTES + RIDGE_CTE))
def q_score_rows(spark, d):
    """Predictions next to the label (M8), of the one-feature regression with a closed form."""
    train, test = _train_test(spark, d)
    model = _fit(M.linear_regression(["DepDelay"], reg_param=0.1, solver="normal"), train)
    return M.score_rows(model, test, keep=KEYS).withColumn("prediction", r6("prediction"))


@query("first_predictions", with_ctes(
    "SELECT l_orderkey, l_linenumber, ArrDelay, round(a + b * DepDelay, 6) AS prediction FROM mi, ols WHERE part = 'test' "
    "ORDER BY l_orderkey, l_linenumber, ArrDelay, prediction LIMIT 10", "clean", extra=MODEL_CTES + RIDGE_CTE))
def q_first_predictions(spark, d):
    """The first ten predictions in key order."""
    return q_score_rows(spark, d).orderBy(*KEYS, LABEL, "prediction").limit(10)


@query("model_comparison", with_ctes(
    f"SELECT * FROM (VALUES ('linear_regression', {N_TEST}, TRUE), ('random_forest', {N_TEST}, TRUE)) "
    "AS v(model, n, r2_positive)", "clean", extra=MODEL_CTES))
def q_model_comparison(spark, d):
    """Linear regression against 50 trees of depth 8, one scan of the test rows."""
    train, test = _train_test(spark, d)
    with M.laid_out(train) as rows:
        models = {"linear_regression": M.linear_regression(MODEL_FEATURES).fit(rows),
                  "random_forest": M.random_forest(MODEL_FEATURES).fit(rows)}
    return M.compare_models(models, test).select("model", "n", (F.col("r2") > 0).alias("r2_positive"))


@query("model_roundtrip", with_ctes(f"SELECT {N_TEST} AS n, CAST(0 AS DOUBLE) AS max_abs_diff", "clean", extra=MODEL_CTES))
def q_model_roundtrip(spark, d):
    """A saved and loaded model predicts the same."""
    train, test = _train_test(spark, d)
    model = _fit(M.linear_regression(MODEL_FEATURES), train)
    again = M.load_model(M.save_model(model, scratch_path(spark, "model")))
    # Both models score the same rows side by side; no join on the (non-unique) keys.
    first = model.transform(test).withColumnRenamed("prediction", "p1").drop("features_vec")
    both = again.transform(first)
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("prediction") - F.col("p1"))).alias("max_abs_diff"))


@query("class_weights", with_ctes(
    "SELECT CAST(ArrDelay >= 15 AS DOUBLE) AS is_delayed, COUNT(*) AS n, "
    "round(0.5 * (SELECT COUNT(*) FROM clean) / COUNT(*), 9) AS class_weight FROM clean GROUP BY 1", "clean"))
def q_class_weights(spark, d):
    return M.class_weights(clean(spark, d)).withColumn("class_weight", F.round("class_weight", 9))


@query("delay_classifier", with_ctes(
    f"SELECT {N_TEST} AS n, TRUE AS better_than_chance", "clean", extra=MODEL_CTES))
def q_delay_classifier(spark, d):
    """The weighted classifier's balanced accuracy on the test rows is above one half."""
    train, test = _train_test(spark, d)
    model = _fit(M.delay_classifier(MODEL_FEATURES), M.with_class_weight(train))
    pred = model.transform(test.withColumn("is_delayed", delayed_flag(LABEL).cast("double")))
    hit = (F.col("prediction") == F.col("is_delayed")).cast("double")
    balanced = (F.avg(F.when(F.col("is_delayed") == 1, hit)) + F.avg(F.when(F.col("is_delayed") == 0, hit))) / 2
    return pred.agg(F.count(F.lit(1)).alias("n"), (balanced > 0.5).alias("better_than_chance"))


# ---------------------------------------------------------------- prose-only items

@query("top_groups_avg_delay", with_ctes(
    "SELECT Origin, round(AVG(ArrDelay), 6) AS avg_delay, COUNT(*) AS n FROM clean GROUP BY Origin "
    "ORDER BY AVG(ArrDelay) DESC, Origin LIMIT 10", "clean"))
def q_top_groups_avg_delay(spark, d):
    out = R.top_groups(clean(spark, d), "Origin", k=10)
    return out.select("Origin", r6("avg_delay").alias("avg_delay"), "n")


@query("dim_enrich", with_ctes(
    "SELECT n_name, COUNT(*) AS n, round(AVG(ArrDelay), 6) AS avg_delay FROM clean "
    "LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) dim "
    "ON Origin = s_suppkey GROUP BY n_name", "clean"))
def q_dim_enrich(spark, d):
    """Mean delay by the origin's nation (supplier x nation as the airport dimension).

    Flights are reduced to one row per origin first (partial aggregation, so a
    busy origin costs nothing extra), and only those per-origin sums meet the
    size-checked dimension; the nation totals are re-aggregated from them.
    """
    nation = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier = read_table(spark, d, "supplier").select(F.col("s_suppkey").alias("Origin"), "s_nationkey")
    dim = R.enrich(supplier, nation, "s_nationkey", "inner").select("Origin", "n_name")
    per_origin = (clean(spark, d).groupBy("Origin")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("ArrDelay").alias("s")))
    joined = R.enrich(per_origin, dim, "Origin", "left")
    return (joined.groupBy("n_name")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
            .select("n_name", "n", r6(F.col("s") / F.col("n")).alias("avg_delay")))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
