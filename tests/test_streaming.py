"""Incremental ingest: exactly the new files' rows, partitioned, on each run."""

from __future__ import annotations

from ontime.plans.registry import FL_TYPES_EXTRA, fl
from ontime.schema import raw_schema_typed
from ontime.session import scratch_path
from ontime.sources.files import read_parquet
from ontime.streaming import ingest_stream, run_until_caught_up
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"


def test_ingest_is_incremental_and_exactly_once(spark):
    src = fl(spark, SF)
    order = src.columns
    base = raw_schema_typed(list(FL_TYPES_EXTRA.items()))
    schema = T.StructType([base[c] for c in order])
    inbox = scratch_path(spark, "inbox")
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    first = src.filter("Month <= 6")
    second = src.filter("Month > 6")
    first.write.option("header", "true").csv(f"{inbox}/batch=1")
    run_until_caught_up(ingest_stream(spark, f"{inbox}/*", out, checkpoint=ckpt, schema=schema))
    n1 = read_parquet(spark, out).count()
    assert n1 == first.count()
    second.write.option("header", "true").csv(f"{inbox}/batch=2")
    run_until_caught_up(ingest_stream(spark, f"{inbox}/*", out, checkpoint=ckpt, schema=schema))
    layer = read_parquet(spark, out)
    assert layer.count() == src.count()
    assert set(layer.columns) >= {"Year", "Month", "ArrDelay"}
    # Re-running with nothing new adds nothing.
    run_until_caught_up(ingest_stream(spark, f"{inbox}/*", out, checkpoint=ckpt, schema=schema))
    assert read_parquet(spark, out).count() == src.count()
