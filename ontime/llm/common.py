"""Small shared helpers of the text operators: reading, lineage cuts, word lists."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.session import scratch_path

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage and survives lost executors; used for small intermediate
    tables (ids, counts, links), never for whole texts.  The shuffle files of
    the write go with its end: a chain of such tables takes the disk of its
    widest step, not of all.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    try:
        spark.conf.set(_CLEAN_UP, "true")
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` wrote and nothing reads any more."""
    jvm, files = df.sparkSession._jvm, df.inputFiles()
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_words(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of A-Z-lower-cased texts: (flat words, owner row of each)."""
    # Lower case before the cast: of a slice cast to large_string, pyarrow 23's ascii_lower returns zero bytes.
    texts = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    for blank in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, blank, " ")
    lists = pc.split_pattern(texts, " ")
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, "")
    return flat.filter(full), owner.filter(full)


def batches_as_arrays(batches: Iterator[pa.RecordBatch], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut incoming Arrow batches to at most ``size`` rows, so a task's memory stays bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
