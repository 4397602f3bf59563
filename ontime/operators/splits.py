"""The best first split of a regression tree, searched over all rows (M6).

``best_splits`` looks at every threshold between two neighbouring values of a
feature and takes the one that lowers the squared error of the label most: what
one tree of depth 1 without bagging learns.  Rows are reduced to one line per
feature and value first (map-side), prefix sums run inside value ranges, and
the ranges' totals (at most ``BUCKETS`` a feature) are summed on top, so no task
sorts a whole feature.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.operators.quantiles import _bucketed, _split_points

#: Value ranges a feature is cut into for the prefix sums.
BUCKETS = 256


def label_sums(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """``(column, v, n, s)``: rows and label total of each value; ``column`` is the feature's position."""
    x = [F.col(c).cast("double") for c in features]
    values = F.array(*[F.struct(F.lit(i).alias("column"), v.alias("v")) for i, v in enumerate(x)])
    rows = df.select(F.col(label).cast("double").alias("y"), F.inline(values))
    rows = rows.filter("y IS NOT NULL AND NOT isnan(y) AND v IS NOT NULL AND NOT isnan(v)")
    return rows.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))


def best_splits(df: DataFrame, features: list[str], label: str, buckets: int = BUCKETS) -> DataFrame:
    """``(feature, threshold, n_left, n_right, mean_left, mean_right, gain)``, a row per feature that can be split.

    ``gain`` is the fall of the label's variance; left means at most the
    threshold, which lies halfway between two values.  Of equal gains the lowest
    threshold wins.  Rows without a label or value are left out; a feature of
    one value has no row.
    """
    sums = label_sums(df, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = _scored(_bucketed(sums, features, _split_points(sums, buckets)), features).collect()  # a row a feature
    finally:
        sums.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "feature string, threshold double, n_left bigint, n_right bigint, mean_left double, mean_right double, gain double")


def _scored(sums: DataFrame, features: list[str]) -> DataFrame:
    of, inside = Window.partitionBy("column").orderBy("bucket"), Window.partitionBy("column", "bucket").orderBy("v")
    upto = (Window.unboundedPreceding, Window.currentRow)
    totals = sums.groupBy("column", "bucket").agg(F.sum("n").alias("bn"), F.sum("s").alias("bs"), F.min("v").alias("first"))
    totals = totals.select(
        F.col("column").alias("c"), F.col("bucket").alias("b"), (F.sum("bn").over(of) - F.col("bn")).alias("n0"),
        (F.sum("bs").over(of) - F.col("bs")).alias("s0"), F.lead("first").over(of).alias("after"),
        F.sum("bn").over(Window.partitionBy("column")).alias("n_all"), F.sum("bs").over(Window.partitionBy("column")).alias("s_all"))
    # At most features x buckets rows on the right.
    rows = sums.join(F.broadcast(totals), (F.col("column") == F.col("c")) & (F.col("bucket") == F.col("b")))
    rows = rows.select("column", "v", "n_all", "s_all", F.coalesce(F.lead("v").over(inside), F.col("after")).alias("next"),
                       (F.col("n0") + F.sum("n").over(inside.rowsBetween(*upto))).alias("nl"),
                       (F.col("s0") + F.sum("s").over(inside.rowsBetween(*upto))).alias("sl")).filter("next IS NOT NULL")
    nr, sr = F.col("n_all") - F.col("nl"), F.col("s_all") - F.col("sl")
    gain = (F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr - F.col("s_all") * F.col("s_all") / F.col("n_all")) / F.col("n_all")
    split = F.struct(gain.alias("gain"), (-F.col("v")).alias("low"), ((F.col("v") + F.col("next")) / 2).alias("threshold"),
                     F.col("nl").alias("n_left"), nr.alias("n_right"), (F.col("sl") / F.col("nl")).alias("mean_left"),
                     (sr / nr).alias("mean_right"))
    best = rows.groupBy("column").agg(F.max(split).alias("s"))
    names = F.array(*[F.lit(c) for c in features])
    return best.select(F.get(names, F.col("column")).alias("feature"), "s.threshold", "s.n_left", "s.n_right", "s.mean_left",
                       "s.mean_right", "s.gain")


@dataclass(frozen=True)
class Stump:
    """The only split of a fitted tree of depth 1."""
    feature: str
    threshold: float
    mean_left: float
    mean_right: float


def fitted_stump(model: PipelineModel, features: list[str]) -> Stump:
    """The split of the first tree of a fitted forest, read from its description."""
    text = model.stages[-1].trees[0].toDebugString
    found = re.search(r"If \(feature (\d+) <= (\S+)\)\s+Predict: (\S+)\s+Else \(feature \d+ > \S+\)\s+Predict: (\S+)", text)
    if not found:
        raise ValueError("the tree has no single split")
    return Stump(features[int(found[1])], float(found[2]), float(found[3]), float(found[4]))
