"""Layer writers and scoped caching.

Writes are ``REBALANCE``-hinted instead of the reference's fixed
``repartition(8)``: AQE then sizes the write tasks from the data, splits a
partition value that holds a large share of the rows into several tasks
(one Month may hold a third of a year) and merges small ones, so the number
and size of output files follow the data rather than a constant.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

#: Files a task of a partitioned ``written`` may hold open before it sorts its rows instead.
OPEN_FILES = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", compression: str = "snappy",
                max_records_per_file: int | None = None,
                require_partition_columns: bool = False, only_partitions: bool = False) -> list[str]:
    """Write a Parquet layer; returns the partition columns used.

    An overwrite replaces the whole layer, whatever it held before; with
    ``only_partitions`` it replaces just the partitions present in ``df``.

    ``partition_by`` keeps only the columns that exist (S11): a frame without
    them is written flat unless ``require_partition_columns`` is set.
    """
    keys = [c for c in (partition_by or []) if c in df.columns]
    if require_partition_columns and len(keys) != len(partition_by or []):
        missing = [c for c in partition_by or [] if c not in df.columns]
        raise ValueError(f"partition columns missing: {missing}")
    out = df.hint("rebalance", *keys) if keys else df.hint("rebalance")
    writer = out.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if keys:
        writer = writer.partitionBy(*keys)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_partitions and keys else "static")
    writer.parquet(path)
    return keys


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, materialize: bool = False):
    """Cache ``df`` for the block and always release it.

    Blocks spilled to disk survive memory pressure; a lost executor only
    recomputes its own partitions from lineage.
    """
    cached = df.persist(level)
    try:
        if materialize:
            cached.count()
        yield cached
    finally:
        cached.unpersist()


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: several passes then cost one of its plan.

    Rows of a few partition values go to as many open files at once; Spark
    sorts a task's rows by the value only where it meets more of them.
    """
    from ontime.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_WRITERS, None)
    try:
        if partition_by:
            spark.conf.set(_WRITERS, str(OPEN_FILES))
        df.write.partitionBy(*(partition_by or [])).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, before)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    Used where a long plan would otherwise be recomputed from the source after
    an executor loss; the files live on shared storage, not on one machine.
    """
    from ontime.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
