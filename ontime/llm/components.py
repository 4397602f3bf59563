"""Connected components of a link table, by alternating large and small stars.

Runs wholly as Spark joins and aggregates: links, labels and components stay
distributed.  A round's minima are written to the shared folder first, so the
join that follows shuffles both sides afresh and AQE can split a node that
holds a large share of all links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import materialize


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) for every node on a link; component is the smallest reachable node.

    Self links and repeated links are harmless; an empty table gives an empty
    result.  Null ends are dropped.  Converges in O(log^2 n) rounds.
    """
    e = (edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
         .filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst"))
    e = materialize(e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                    .distinct(), "links")
    before = _fingerprint(e)
    while before[0]:
        # Large star: every larger neighbour of a node is tied to the node's smallest neighbour.
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = materialize(both.groupBy("src").agg(F.min("dst").alias("m"))
                          .select(F.col("src").alias("k"), F.least("src", "m").alias("m")), "stars")
        large = (both.join(low, both["src"] == low["k"]).filter("dst > src")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())
        large = materialize(large, "links")
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        low = materialize(large.groupBy("src").agg(F.min("dst").alias("m"))
                          .withColumnRenamed("src", "k"), "stars")
        small = (large.join(low, large["src"] == low["k"])
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .unionByName(low.select(F.col("k").alias("src"), F.col("m").alias("dst")))
                 .filter("src <> dst").distinct())
        e = materialize(small, "links")
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
