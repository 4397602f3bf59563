"""SimHash near-dedup: a binary trie of fingerprints joined with itself.

1. ``fingerprints``: 64-bit SimHash of word shingles, computed in Arrow batches.
2. Equal fingerprints are folded into one, so copies never form pairs.
3. Trie self-join.  A pair within ``budget`` = 3 bits agrees in at least one of
   four 16-bit blocks.  The trie is therefore planted in four rotations, each
   with another block on top; in a rotation's top 16 levels a node only meets
   itself, so (rotation, top block) is the shuffle key.  Below, node pairs are
   walked together: differing bits accumulate level by level and a pair of
   nodes is dropped once it exceeds the budget.
4. A top node with many fingerprints (a large near-copy group) is cut into
   chunks by hash; each pair of chunks is walked as a node pair of its own, so
   one hot node becomes many tasks of bounded size.
5. A task returns a spanning forest of its links instead of all pairs;
   ``connected_components`` joins the forests.  No link is lost and nothing is
   collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import materialize
from ontime.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 3
BLOCKS = 4
BLOCK_BITS = 16
#: Fingerprints in a chunk of a wide top node, about.
SPLIT_ROWS = 1024
#: Pairs of fingerprints compared at a time; bounds a task's arrays.
CELLS = 1 << 17


def simhash(text: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text; bytes.lower / split know exactly A-Z and the six ASCII blanks."""
    words = text.lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else (
        list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), dtype="<u8", count=len(grams))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(h), 65536):
        part = h[start:start + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp): fp is the 64-bit SimHash as a signed long; no words: 0; null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t.as_py() or b"", shingle, seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return (docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("binary").alias("t"))
            .mapInArrow(run, "id bigint, fp bigint"))


def trie_pairs(values: np.ndarray, roots: np.ndarray, bit: int = 63, budget: int = BUDGET,
               leaf: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j within ``budget`` bits, walking node pairs of a binary trie together.

    A trie node is a range of ``values`` that is sorted and agrees in all bits
    above ``bit``.  ``roots`` are the node pairs to start from, one row each:
    low and high of the left node, low and high of the right node (the same
    range twice joins a node with itself).  The frontier of node pairs goes
    down level by level; a pair that has used up its error budget is dropped,
    and one of at most ``leaf`` cells is compared directly.
    """
    frontier = [(bit, np.column_stack([roots, np.zeros(len(roots), dtype=np.int64)]).astype(np.int64))]
    while frontier:
        bit, nodes = frontier.pop()
        cells = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        small = cells <= (leaf if bit >= 0 else np.inf)
        yield from _leaf_pairs(values, nodes[small], budget)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        mask = np.uint64(1) << np.uint64(bit)
        cut_l, cut_r = _cuts(values, nodes[:, 0], nodes[:, 1], mask), _cuts(values, nodes[:, 2], nodes[:, 3], mask)
        same = (nodes[:, 0] == nodes[:, 2]) & (nodes[:, 1] == nodes[:, 3])
        children = []
        for a in (0, 1):
            for b in (0, 1):
                child = np.column_stack([cut_l if a else nodes[:, 0], nodes[:, 1] if a else cut_l,
                                         cut_r if b else nodes[:, 2], nodes[:, 3] if b else cut_r,
                                         nodes[:, 4] + (a != b)])
                keep = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3]) & (child[:, 4] <= budget)
                if (a, b) == (1, 0):
                    keep &= ~same  # a node met with itself has this pair as (0, 1) already
                children.append(child[keep])
        nodes = np.concatenate(children)
        frontier += [(bit - 1, nodes[i:i + (1 << 14)]) for i in range(0, len(nodes), 1 << 14)]


def _leaf_pairs(values: np.ndarray, nodes: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Compare all cells of small node pairs, ``CELLS`` at a time."""
    width = nodes[:, 3] - nodes[:, 2]
    ends = np.cumsum((nodes[:, 1] - nodes[:, 0]) * width)
    for low in range(0, int(ends[-1]) if len(ends) else 0, CELLS):
        cell = np.arange(low, min(low + CELLS, int(ends[-1])))
        row = np.searchsorted(ends, cell, side="right")
        at = cell - np.where(row, ends[row - 1], 0)
        i, j = nodes[row, 0] + at // width[row], nodes[row, 2] + at % width[row]
        near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        yield i[near], j[near]


def _cuts(values: np.ndarray, low: np.ndarray, high: np.ndarray, mask: np.uint64) -> np.ndarray:
    """First index in each [low, high) whose bit is set; the values of a range share all bits above."""
    a, b = low.copy(), high.copy()
    while (open_ := a < b).any():
        mid = (a + b) // 2
        one = open_ & ((values[np.minimum(mid, len(values) - 1)] & mask) != 0)
        b = np.where(one, mid, b)
        a = np.where(open_ & ~one, mid + 1, a)
    return a


def spanning_links(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n nodes the smallest node it is linked to, over batches of pairs."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            if (a == b).all():
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    return root


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the node pairs of one partition; rows come sorted by group, side, key."""
    keys = ["rotation", "top", "a", "b"]

    def links(ids: np.ndarray, side: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
        end = np.r_[start[1:], len(ids)]
        ones = np.add.reduceat((side == 1).astype(np.int64), start)
        own = side[start] == 2
        roots = np.column_stack([start, np.where(own, end, end - ones), np.where(own, start, end - ones), end])
        values = key.view(np.uint64)
        root = spanning_links(len(ids), trie_pairs(values, roots, 63 - BLOCK_BITS))
        linked = np.flatnonzero(root != np.arange(len(ids)))
        turn = ids[linked, 0].astype(np.uint64) * np.uint64(BLOCK_BITS)
        rest = (np.uint64(64) - turn) % np.uint64(64)
        back = lambda x: pa.array(((x >> turn) | (x << rest)).view(np.int64))
        return pa.RecordBatch.from_arrays([back(values[linked]), back(values[root[linked]])], names=["src", "dst"])

    held = None  # the rows of the last group, which may go on in the next batch
    for batch in batches:
        rows = [np.column_stack([batch.column(k).to_numpy().astype(np.int64) for k in keys]),
                batch.column("side").to_numpy(), batch.column("key").to_numpy()]
        rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        cut = int(np.argmax((rows[0] == rows[0][-1]).all(axis=1)))
        if cut:
            yield links(*(x[:cut] for x in rows))
        held = [x[cut:].copy() for x in rows]
    if held is not None and len(held[0]):
        yield links(*held)


def fingerprint_links(fps: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(src, dst) links whose connected components are those of "within 3 bits" over column ``fp``."""
    rotations = [F.struct(F.lit(r).alias("rotation"),
                          (F.shiftleft("fp", BLOCK_BITS * r).bitwiseOR(
                              F.shiftrightunsigned("fp", 64 - BLOCK_BITS * r)) if r else F.col("fp")).alias("key"))
                 for r in range(BLOCKS)]
    rows = (fps.select("fp").distinct().select(F.explode(F.array(*rotations)).alias("x")).select("x.*")
            .withColumn("top", F.shiftrightunsigned("key", 64 - BLOCK_BITS)))
    rows = materialize(rows, "rotations")
    # A fingerprint alone under its top node links to nothing; a wide node is cut into chunks.
    tops = materialize(rows.groupBy("rotation", "top").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                       .select(F.col("rotation").alias("r"), F.col("top").alias("t"),
                               F.ceil(F.col("n") / split_rows).alias("chunks")), "tops")
    rows = rows.join(tops, (F.col("rotation") == F.col("r")) & (F.col("top") == F.col("t")))
    rows = (rows.withColumn("own", F.pmod(F.xxhash64("key"), F.col("chunks")))
            .withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)"))))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    rows = rows.select("rotation", "top", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                       side.alias("side"), "key")
    group = ["rotation", "top", "a", "b"]
    return (rows.repartition(*group).sortWithinPartitions(*group, "side", "key")
            .mapInArrow(_join_groups, "src bigint, dst bigint"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (smallest reachable id).

    Rows whose fingerprints differ in at most 3 bits are linked; components are
    the transitive closure.  Null and blank texts have fingerprint zero and
    are linked like any other.  Null ids never name a component unless all ids
    in it are null.  Repeated rows give repeated results.  Other columns are
    ignored.
    """
    fps = materialize(fingerprints(docs, id_column, text_column), "fingerprints")
    low = materialize(fps.groupBy("fp").agg(F.min("id").alias("low")), "classes")
    parts = materialize(connected_components(fingerprint_links(low), "src", "dst"), "components")
    # Class table: fingerprint -> smallest id of its component.
    named = low.join(parts, low["fp"] == parts["node"], "left").withColumn("c", F.coalesce("component", "fp"))
    named = materialize(named.select("fp", "c", "low"), "named")
    best = materialize(named.groupBy("c").agg(F.min("low").alias("component_id")), "best")
    classes = materialize(named.select("fp", "c").join(best, "c").select(F.col("fp").alias("k"), "component_id"),
                          "classes")
    return (fps.join(classes, fps["fp"] == classes["k"])
            .select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each near-duplicate group the row with the smallest id.

    Rows of equal id and text are one document, of which one row stays.  Rows
    without an id can't be named by the decision and stay.
    """
    found = near_duplicates(docs, id_column, text_column)
    winners = materialize(found.filter(F.col(id_column) == F.col("component_id")).select(id_column).distinct(), "winners")
    kept = docs.join(winners, id_column).select(docs.columns).dropDuplicates([id_column, text_column])
    return kept.unionByName(docs.filter(F.col(id_column).isNull()))
