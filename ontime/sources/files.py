"""File readers: CSV (raw or declared schema) and Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ontime.operators.cleaning import cast_columns
from ontime.schema import data_type, raw_schema_typed

# Text tokens the flight CSVs use for a missing number.
DEFAULT_NULL_TOKEN = "NA"


def read_csv_raw(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headered CSV, every column a string (S1); no inference pass."""
    return spark.read.option("header", "true").option("sep", sep).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   null_value: str = DEFAULT_NULL_TOKEN, infer: bool = False,
                   sep: str = ",", types: dict[str, str] | None = None) -> DataFrame:
    """Headered CSV with declared types.

    ``null_value`` turns the ``NA`` token into null, so numeric columns can be
    declared numeric.  ``infer=True`` keeps the reference's ``inferSchema``
    behaviour, which costs one extra pass over the files.  Malformed values in
    a declared numeric column become null (PERMISSIVE mode).
    """
    reader = (spark.read.option("header", "true").option("sep", sep)
              .option("nullValue", null_value).option("mode", "PERMISSIVE"))
    if infer:
        return reader.option("inferSchema", "true").csv(path)
    if schema is None:
        schema = _header_schema(spark, path, sep, types)
    text, cast = text_for_integers(schema)
    return cast(reader.schema(text).option("enforceSchema", "false").csv(path))


def text_for_integers(schema: T.StructType) -> tuple[T.StructType, Callable[[DataFrame], DataFrame]]:
    """The schema with integer columns as text, and the cast back.

    A CSV written from floating-point columns says ``745.0`` for 745, which
    the reader would take for a malformed integer.
    """
    whole = {f.name: f.dataType.simpleString() for f in schema.fields if isinstance(f.dataType, T.IntegralType)}
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name in whole else f.dataType, True)
                         for f in schema.fields])
    return text, lambda df: cast_columns(df, whole)


def _header_schema(spark: SparkSession, path: str, sep: str,
                   types: dict[str, str] | None = None) -> T.StructType:
    """Declared flight types (plus ``types``) for known columns, string for the rest.

    Only the header line is read to learn the column order; the data is never
    scanned for inference.
    """
    header = spark.read.option("header", "true").option("sep", sep).csv(path).columns
    known = {f.name: f.dataType for f in raw_schema_typed().fields}
    known.update({c: data_type(t) for c, t in (types or {}).items()})
    return T.StructType([T.StructField(c, known.get(c, T.StringType()), True) for c in header])


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet scan (S3); ``merge_schema`` reads every footer (S4), off by default."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on its file system.

    One metadata call through the Hadoop ``FileSystem`` of the path (as the
    reference did); a session without JVM access (Spark Connect) falls back
    to resolving the path as a data source, which lists the folder but reads
    no data.
    """
    try:
        jvm = spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(jpath))
    except (AttributeError, TypeError):
        pass
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018 - listing only
        return True
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return False
        raise
