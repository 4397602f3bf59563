"""One table from Parquet files whose column types disagree.

``mergeSchema`` adds missing columns but fails where a column is an integer in
one month and text or a double in another.  Here footers are read in tasks and
files grouped by their schema; each group is one scan, its columns cast to the
common type of all groups, and the scans are one union.  The number of scans is
that of different schemas, not of files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.sources.catalog import declare_table
from ontime.sources.sinks import write_layer

# Integers and the decimal digits they need.
_INTEGERS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def common_type(types: list[T.DataType]) -> T.DataType:
    """The narrowest type that all of ``types`` go into.

    Integers widen; with decimals they become a decimal of enough digits, or a
    double beyond 38; with floating-point numbers all become double; date and
    timestamp become timestamp; anything else becomes text.
    """
    kinds = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(kinds) < 2:
        return kinds[0] if kinds else T.StringType()
    if all(t in _INTEGERS for t in kinds):
        return max(kinds, key=_INTEGERS.get)
    if all(isinstance(t, T.NumericType) for t in kinds):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in kinds):
            return T.DoubleType()
        shapes = [(_INTEGERS[t], 0) if t in _INTEGERS else (t.precision - t.scale, t.scale) for t in kinds]
        whole, scale = max(s[0] for s in shapes), max(s[1] for s in shapes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in kinds):
        return T.TimestampType()
    return T.StringType()


@dataclass(frozen=True)
class SchemaGroup:
    """Files of one schema: folders that hold nothing else, and single files of mixed folders."""
    paths: tuple[str, ...]
    files: int
    schema: T.StructType


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = []
        for path in paths:
            at = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
            system, inner = fs.FileSystem.from_uri(at) if ":" in at else (fs.LocalFileSystem(), at)
            found.append(pq.read_schema(inner, filesystem=system).remove_metadata().to_string(show_field_metadata=False))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], names=["path", "signature"])


def schema_groups(spark: SparkSession, path: str) -> list[SchemaGroup]:
    """The different schemas under ``path``, largest group first.

    Files are listed by Spark and footers read in its tasks (through Arrow's
    file systems: local, HDFS, S3, GCS).  The driver gets one row per folder,
    and the file names of folders that hold more than one schema.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))
    found = files.mapInArrow(_signatures, "path string, signature string")
    found = found.withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    folders = found.groupBy("folder", "signature").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("example"))
    folders = folders.persist()
    try:
        rows = folders.collect()
        kinds: dict[str, int] = {}
        for r in rows:
            kinds[r["folder"]] = kinds.get(r["folder"], 0) + 1
        mixed = [f for f, n in kinds.items() if n > 1]
        single: dict[str, list[str]] = {}
        if mixed:
            names = found.join(folders.groupBy("folder").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "folder")
            for r in names.select("signature", "path").collect():
                single.setdefault(r["signature"], []).append(r["path"])
    finally:
        folders.unpersist()
    groups: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r["example"]):
        group = groups.setdefault(r["signature"], [[], 0, r["example"]])
        group[1] += r["n"]
        if kinds[r["folder"]] == 1:
            group[0].append(r["folder"])
    out = [SchemaGroup(tuple(paths + sorted(single.get(s, []))), n, spark.read.parquet(example).schema)
           for s, (paths, n, example) in groups.items()]
    return sorted(out, key=lambda g: (-g.files, g.paths))


def target_schema(groups: list[SchemaGroup], types: dict[str, T.DataType] | None = None) -> T.StructType:
    """Columns of all groups in order of first appearance, each of its stated or else common type."""
    held: dict[str, list[T.DataType]] = {}
    for g in groups:
        for f in g.schema.fields:
            held.setdefault(f.name, []).append(f.dataType)
    return T.StructType([T.StructField(c, (types or {}).get(c) or common_type(t)) for c, t in held.items()])


def reconciled_scan(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None,
                    groups: list[SchemaGroup] | None = None) -> DataFrame:
    """All rows under ``path`` with the columns and types of ``target_schema``.

    A value that doesn't go into its target type becomes null (``try_cast``; only
    where ``types`` asks for less than the common type), a column a file lacks
    is null there.  Folder names ``key=value`` become columns as in any scan.
    """
    groups = schema_groups(spark, path) if groups is None else groups
    if not groups:
        raise FileNotFoundError(f"no Parquet file under {path}")
    target = target_schema(groups, types)
    parts = []
    for g in groups:
        df = spark.read.option("basePath", path).parquet(*g.paths)
        there = set(g.schema.names)
        cast = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in target.fields]
        parts.append(df.select(*cast, *[F.col(f"`{c}`") for c in df.columns if c not in there]))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def conflict_report(groups: list[SchemaGroup], spark: SparkSession) -> DataFrame:
    """``(column, type, files, target)`` of the columns whose types differ between files."""
    target, files = target_schema(groups), {}
    for g in groups:
        for f in g.schema.fields:
            key = (f.name, f.dataType.simpleString())
            files[key] = files.get(key, 0) + g.files
    several = {c for c in target.names if sum(c == k for k, _ in files) > 1}
    rows = [(c, t, n, target[c].dataType.simpleString()) for (c, t), n in files.items() if c in several]
    return spark.createDataFrame(rows, "column string, type string, files bigint, target string")


def reconciled_table(spark: SparkSession, source: str, table: str, path: str, partition_by: list[str] | None = None,
                     types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Write the reconciled rows of ``source`` as a layer at ``path`` and declare it with generated, typed columns."""
    df = reconciled_scan(spark, source, types)
    keys = write_layer(df, path, partition_by)
    return declare_table(spark, table, path, df.schema, keys)
