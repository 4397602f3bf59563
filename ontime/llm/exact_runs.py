"""Exact dedup: tree-merge of sorted digest runs.

Each input partition is one run: its rows' digests are sorted in the task and
rows of equal digest are folded into one entry.  Runs are then merged in
rounds of ``fan_in``: round r brings the runs with equal ``run // fan_in**r``
together, shard by shard (a shard is a range of digests, so no task ever holds
a whole run), Spark's shuffle sort merges them, and one streaming pass folds
adjacent equal digests.  A digest that holds a third of the corpus enters a
merge at most once per run.  Every fold verifies the entries: equal SHA-256
digests must also agree in length and in an independent 64-bit hash, else the
entries stay apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import materialize, shuffle_partitions

#: Runs merged at a time.
FAN_IN = 8
#: Digest shards; each is merged by itself.
SHARDS = 256

ENTRY = ["digest", "check", "size", "keep_id", "n"]
ENTRY_TYPES = "digest string, check bigint, size bigint, keep_id bigint, n bigint"


def _fold(keep_largest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fold adjacent rows that agree in (shard, run, digest, check, size); input is sorted so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            new = np.zeros(table.num_rows, dtype=bool)
            new[0] = True
            for name in ("shard", "run", "digest", "check", "size"):
                values = table[name].combine_chunks()
                new[1:] |= np.asarray(pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False),
                                      dtype=bool)
            first = np.flatnonzero(new)
            # Null ids rank below every id, so an identified row is kept first.
            low = np.iinfo(np.int64).min if keep_largest else np.iinfo(np.int64).max
            ids = pc.fill_null(table["keep_id"].combine_chunks(), int(low)).to_numpy()
            kept = (np.maximum if keep_largest else np.minimum).reduceat(ids, first)
            n = np.add.reduceat(table["n"].to_numpy(), first)
            out = table.take(pa.array(first))
            out = out.set_column(out.schema.get_field_index("keep_id"), "keep_id",
                                 pa.array(kept, mask=kept == low, type=pa.int64()))
            out = out.set_column(out.schema.get_field_index("n"), "n", pa.array(n, type=pa.int64()))
            # The last entry may go on in the next batch.
            head = out.slice(0, out.num_rows - 1)
            held = pa.RecordBatch.from_struct_array(out.slice(out.num_rows - 1).to_struct_array().combine_chunks())
            yield from head.to_batches()
        if held is not None:
            yield held

    return run


def digest_classes(entries: DataFrame, keep_largest: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """Merge rows (digest, check, size, keep_id, n) to one row per distinct text.

    The run of a row is the partition it is read in; merging depends on it only
    for speed, never for the result.
    """
    shard = F.pmod(F.conv(F.substring("digest", 1, 4), 16, 10).cast("int"), F.lit(SHARDS))
    types = f"shard int, run bigint, {ENTRY_TYPES}"
    order = ["shard", "run", "digest", "check", "size"]
    runs = (entries.withColumn("shard", shard).withColumn("run", F.spark_partition_id().cast("bigint"))
            .select("shard", "run", *ENTRY).sortWithinPartitions(*order)
            .mapInArrow(_fold(keep_largest), types))
    runs = materialize(runs, "runs")
    last = runs.agg(F.max("run")).first()[0] or 0
    parts = shuffle_partitions(entries.sparkSession)
    while last:
        merged = (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("bigint"))
                  .repartition(parts, "shard", "run").sortWithinPartitions(*order)
                  .mapInArrow(_fold(keep_largest), types))
        last //= fan_in
        runs = materialize(merged, "runs") if last else merged
    return runs.select(*ENTRY)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                normalize: Callable[[Column], Column] | None = None, keep_largest: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Null texts count as empty.  Rows are equal when their (normalised) texts
    are; of a group the smallest id stays (``keep_largest``: the largest).
    Repeated rows with the kept id all say ``kept``; a group whose ids are all
    null keeps id null.  Other columns of ``docs`` are ignored.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    text = normalize(text) if normalize else text
    rows = docs.select(F.col(id_column).cast("bigint").alias("keep_id"), text.alias("t"))
    rows = materialize(rows.select("keep_id", F.sha2("t", 256).alias("digest"), F.xxhash64("t").alias("check"),
                                   F.octet_length("t").cast("bigint").alias("size"), F.lit(1).cast("bigint").alias("n")),
                       "digests")
    classes = materialize(digest_classes(rows, keep_largest), "classes").select(
        "digest", "check", "size", F.col("keep_id").alias("best"), F.col("n").alias("group_size"))
    return (rows.join(classes, ["digest", "check", "size"])
            .select(F.col("keep_id").alias(id_column), F.col("best").alias("keep_id"), "group_size",
                    F.col("keep_id").eqNullSafe(F.col("best")).alias("kept"), F.col("digest").alias("text_sha256")))
