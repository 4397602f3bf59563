"""Incremental ETL: new flight CSV files -> the partitioned Parquet layer.

The batch ETL (stage 1) rewrites the whole layer; this is the same step as a
Structured Streaming query, so each monthly file is read once when it lands.
The file source needs a declared schema (no inference on a stream); the
Parquet file sink commits through its metadata log in the checkpoint folder,
so a restarted or retried query neither loses nor duplicates files.  The
checkpoint lives under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ontime.schema import PARTITION_KEYS, raw_schema_typed
from ontime.session import scratch_path
from ontime.sources.files import DEFAULT_NULL_TOKEN, text_for_integers


#: Files written for a partition value in a trigger, at most.
FILES_PER_PARTITION = 4


def read_csv_stream(spark: SparkSession, csv_dir: str, schema: T.StructType | None = None,
                    null_value: str = DEFAULT_NULL_TOKEN, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV source with the declared flight schema."""
    text, cast = text_for_integers(schema or raw_schema_typed())
    reader = (spark.readStream.schema(text)
              .option("header", "true").option("nullValue", null_value).option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return cast(reader.csv(csv_dir))


def ingest_stream(spark: SparkSession, csv_dir: str, out_path: str, checkpoint: str | None = None,
                  schema: T.StructType | None = None, partition_by: list[str] | None = None,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental ingest; with ``available_now`` it stops when caught up.

    Rows without a partition key are dropped, as the batch ETL does.
    """
    src = read_csv_stream(spark, csv_dir, schema)
    keys = [k for k in (partition_by or PARTITION_KEYS) if k in src.columns]
    if keys:
        src = src.dropna(how="any", subset=keys)
        # A few writers for each partition value: at most FILES_PER_PARTITION files of it a trigger, and a value
        # that holds most rows is spread over as many tasks.
        salt = F.pmod(F.xxhash64(*src.columns), F.lit(FILES_PER_PARTITION))
        src = src.repartition(*keys, salt)
    writer = (src.writeStream.format("parquet")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "ingest-checkpoint"))
              .outputMode("append"))
    if keys:
        writer = writer.partitionBy(*keys)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_until_caught_up(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until an ``availableNow`` query has processed everything, then stop it."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise exc
