"""Catalog tables and first-available source.

Tables are registered ``USING PARQUET`` over a path with the schema taken from
the files (never a hand-written column list, D11), partitions are recovered
whenever the table is partitioned (D10, D12), and a re-run replaces stale
metadata instead of keeping it (D13).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.sources.files import path_exists, read_csv_typed, read_parquet


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def sql_text(value: str) -> str:
    """A SQL text literal of any value."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def list_tables(spark: SparkSession, database: str | None = None, pattern: str | None = None) -> DataFrame:
    """Tables of a database as a DataFrame (name, database, type, is_temporary)."""
    rows = [(t.name, t.database, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(database, pattern)]
    return spark.createDataFrame(rows, "name string, database string, tableType string, isTemporary boolean")


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def scan_table(spark: SparkSession, table: str, limit: int | None = None) -> DataFrame:
    """Catalog table scan (S5); ``limit`` gives the SQL preview of S6."""
    df = spark.table(table)
    return df.limit(limit) if limit is not None else df


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def recover_partitions(spark: SparkSession, table: str) -> bool:
    """``MSCK REPAIR`` only on a partitioned table (S17, D12); returns whether it ran."""
    if not partition_columns(spark, table):
        return False
    spark.catalog.recoverPartitions(table)
    return True


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(table)}").filter("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{table} has no location")
    return rows[0]["data_type"]


def partition_diff(spark: SparkSession, table: str) -> DataFrame:
    """``(partition, change)``: folders with files that the catalog lacks (``add``), and the reverse (``drop``).

    ``partition`` is the folder name, ``Year=2006/Month=1``.  Files are listed by
    Spark, and the two sides meet in a join.
    """
    keys = partition_columns(spark, table)
    if not keys:
        return spark.createDataFrame([], "partition string, change string")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!._]*")
             .load(table_location(spark, table)).select("path"))
    level = "/".join(f"{re.escape(k)}=[^/]*" for k in keys)
    folders = files.select(F.regexp_extract("path", f"/({level})/[^/]+$", 1).alias("partition")).filter("partition <> ''").distinct()
    known = spark.sql(f"SHOW PARTITIONS {_quote(table)}").select(F.col("partition").alias("known"))
    both = folders.join(known, F.col("partition") == F.col("known"), "full_outer").filter("partition IS NULL OR known IS NULL")
    return both.select(F.coalesce("partition", "known").alias("partition"),
                       F.when(F.col("known").isNull(), "add").otherwise("drop").alias("change"))


def _partition_spec(partition: str) -> str:
    """SQL of a folder name; Hive's name for a null value is null."""
    parts = []
    for part in partition.split("/"):
        key, value = (unquote(x) for x in part.split("=", 1))
        parts.append(f"`{key}` = " + ("NULL" if value == "__HIVE_DEFAULT_PARTITION__" else sql_text(value)))
    return f"PARTITION ({', '.join(parts)})"


#: Partitions named in one statement.
SPECS_PER_STATEMENT = 200


def sync_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Add and drop just the partitions of ``partition_diff`` and return them; a table in step costs one listing.

    Only the differences reach the driver, as the catalog is told of each.
    """
    changes = partition_diff(spark, table).collect()
    for change, words, between in (("drop", "DROP IF EXISTS", ", "), ("add", "ADD IF NOT EXISTS", " ")):
        specs = [_partition_spec(r["partition"]) for r in changes if r["change"] == change]
        for start in range(0, len(specs), SPECS_PER_STATEMENT):
            spark.sql(f"ALTER TABLE {_quote(table)} {words} {between.join(specs[start:start + SPECS_PER_STATEMENT])}")
    if changes:
        refresh(spark, table)
    return spark.createDataFrame([tuple(r) for r in changes], "partition string, change string")


def refresh(spark: SparkSession, table: str) -> None:
    """Drop cached file listings and metadata of a table."""
    spark.catalog.refreshTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """``DROP TABLE IF EXISTS`` (S16); external data files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quote(table)}")


def register_external(spark: SparkSession, table: str, path: str, replace: bool = True) -> DataFrame:
    """Register a Parquet folder as an external table and return it.

    The schema and partition columns come from the files.  A partitioned
    folder is repaired right away, otherwise it would count zero rows.
    """
    if replace:
        drop_table(spark, table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quote(table)} USING PARQUET LOCATION {sql_text(path)}")
    recover_partitions(spark, table)
    refresh(spark, table)
    return spark.table(table)


def table_ddl(table: str, path: str, schema: T.StructType, partition_by: list[str] | None = None) -> str:
    """``CREATE TABLE`` of an external Parquet folder with every column declared, types in full."""
    columns = ",\n  ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in partition_by or [])
    return (f"CREATE TABLE {_quote(table)} (\n  {columns}\n) USING PARQUET"
            + (f"\nPARTITIONED BY ({keys})" if keys else "") + f"\nLOCATION {sql_text(path)}")


def declare_table(spark: SparkSession, table: str, path: str, schema: T.StructType,
                  partition_by: list[str] | None = None) -> DataFrame:
    """Replace ``table`` by a declared external table over ``path`` (S13): no file is read to learn its columns."""
    drop_table(spark, table)
    spark.sql(table_ddl(table, path, schema, partition_by))
    recover_partitions(spark, table)
    refresh(spark, table)
    return spark.table(table)


def save_as_table(df: DataFrame, table: str, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> DataFrame:
    """Write a new copy and register it in one step.

    The target must not be the path the DataFrame reads from (the reference
    overwrote its own input, which deletes the files mid-read): raises
    ``ValueError`` if an input file lies under ``path``.
    """
    target = path.split(":", 1)[-1].rstrip("/") if path.startswith("file:") else path.rstrip("/")
    target = re.sub("^/+", "/", target)
    for f in df.inputFiles():
        if re.sub("^/+", "/", f.removeprefix("file:")).startswith(target + "/"):
            raise ValueError(f"{path} holds input files of the DataFrame, such as {f}")
    writer = df.write.mode(mode).option("path", path).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def save_bucketed(df: DataFrame, table: str, path: str, by: list[str], buckets: int,
                  sort_by: list[str] | None = None) -> DataFrame:
    """Write and register a table hashed into ``buckets`` by ``by`` and sorted in them.

    Later joins and aggregates on ``by`` read it without a shuffle (joins: with
    a table of as many buckets).  Rows are rebalanced by bucket first, so a
    bucket is one file unless it is large, and a hot one is written by several
    tasks.  Choose ``buckets`` for the data: the bytes of one should fit a task.
    """
    bucket = F.pmod(F.hash(*by), F.lit(buckets))  # the hash that bucketing uses
    drop_table(df.sparkSession, table)
    (df.withColumn("__bucket", bucket).hint("rebalance", "__bucket").drop("__bucket").write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, *by).sortBy(*(sort_by or by)).saveAsTable(table))
    return df.sparkSession.table(table)


@dataclass(frozen=True)
class Candidate:
    """One place data may live: ``kind`` is ``table``, ``parquet`` or ``csv``."""
    kind: str
    location: str


def load_first(spark: SparkSession, candidates: list[Candidate],
               merge_schema: bool = False) -> tuple[DataFrame, Candidate]:
    """The first candidate that exists, in the given order.

    Only "not there" is a reason to move on (missing table or path); any
    other error is raised, so a broken table is never silently replaced by a
    stale file, and an empty one is returned empty.  Nothing is written:
    partitions are recovered on registration (``register_external``) or by
    ``recover_partitions``.
    """
    tried = []
    for cand in candidates:
        if cand.kind == "table":
            if table_exists(spark, cand.location):
                return spark.table(cand.location), cand
            tried.append(cand)
            continue
        if not path_exists(spark, cand.location):
            tried.append(cand)
            continue
        if cand.kind == "parquet":
            return read_parquet(spark, cand.location, merge_schema=merge_schema), cand
        if cand.kind == "csv":
            return read_csv_typed(spark, cand.location), cand
        raise ValueError(f"unknown candidate kind {cand.kind!r}")
    raise FileNotFoundError(f"no candidate source exists: {tried}")
