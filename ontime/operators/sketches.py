"""Stored, mergeable profiles (A3-A6): profile any range of groups again without reading its rows.

``store_sketches`` keeps moments and one KLL sketch per group and column; a load writes
its own folder, so loading the same rows twice replaces their sketches and
never counts them double.  ``merged_quantiles``, ``merged_ranks``,
``merged_summary`` and ``merged_profile`` answer for any groups taken together.  Sketches are built map-side and merged by aggregates:
a group that holds a third of the rows is summed in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.operators.profile import PROFILE_ORDER, PROFILE_PROBS, PROFILE_QUANTILE_NAMES
from ontime.operators.quantiles import long_values, wide_quantiles
from ontime.sources.sinks import write_layer

#: Accuracy parameter of a sketch; about 12 bytes times this a sketch.
DEFAULT_K = 2048


def rank_error(k: int = DEFAULT_K) -> float:
    """Stated error of a rank as a share of the rows.

    Twice the bound that KLL sketches keep with 99 % confidence for one
    quantile (2.296 / k^0.9723), so that whole reports keep it too.
    """
    return 2 * 2.296 / k ** 0.9723


def build_sketches(df: DataFrame, columns: list[str], by: list[str], k: int = DEFAULT_K) -> DataFrame:
    """``(by..., column, n, mean, m2, low, high, sketch)``: each column's real values in each group; none for a group without.

    ``m2`` is the sum of squared deviations from the mean.

    Null and NaN values are left out.  Group columns may be null.
    """
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    wide = df.select(*keys, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_v{i}").alias("v")) for i, c in enumerate(columns)])
    long = wide.select(*[f"_g{i}" for i in range(len(by))], F.inline(values)).filter("v IS NOT NULL AND NOT isnan(v)")
    found = long.groupBy(*[f"_g{i}" for i in range(len(by))], "column").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count(F.lit(1))).alias("m2"),
        F.min("v").alias("low"), F.max("v").alias("high"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))
    return found.withColumnsRenamed({f"_g{i}": c for i, c in enumerate(by)})


def store_sketches(df: DataFrame, columns: list[str], by: list[str], path: str, load: str, k: int = DEFAULT_K) -> None:
    """Write the sketches of one load beside those of other loads; the same ``load`` again replaces its own."""
    out = build_sketches(df, columns, by, k).withColumn("load", F.lit(load))
    write_layer(out, path, ["load"], only_partitions=True, require_partition_columns=True)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def merged_quantiles(sketches: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """``(by..., column, probability, value, n)`` of the sketches taken together, by group if asked.

    A value's rank is within ``rank_error`` of its probability; probabilities 0
    and 1 give the exact least and greatest value, ``n`` is exact.
    """
    at = F.array(*[F.lit(float(p)) for p in probs])
    values = F.kll_sketch_get_quantile_double("sketch", at)
    return (_merged(sketches, by or []).select(*(by or []), "column", "n", F.inline(F.arrays_zip(
        at.alias("probability"), values.alias("value")))).select(*(by or []), "column", "probability", "value", "n"))


def merged_summary(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(by..., column, count, mean, stddev, min, max)`` of the groups taken together: exact, as from the rows (A3).

    Deviations are summed about the common mean, so large means cost no digits.
    """
    keys = [*(by or []), "column"]
    all_ = Window.partitionBy(*keys)  # a row per group and load
    centre = F.sum(F.col("n") * F.col("mean")).over(all_) / F.sum("n").over(all_)
    parts = sketches.select(*keys, "n", "mean", "low", "high", "m2", centre.alias("centre"))
    about = F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) * (F.col("mean") - F.col("centre"))
    total = parts.groupBy(*keys).agg(F.sum("n").alias("count"), F.first("centre").alias("mean"), F.sum(about).alias("m2"),
                                     F.min("low").alias("min"), F.max("high").alias("max"))
    spread = F.sqrt(F.try_divide(F.col("m2"), (F.col("count") - 1).cast("double")))
    return total.select(*keys, "count", "mean", spread.alias("stddev"), "min", "max")


def merged_profile(sketches: DataFrame, column: str) -> DataFrame:
    """The 13-metric ``(ord, metric, value)`` table of ``tidy_profile`` from stored groups.

    Count, moments and bounds are exact, quantiles within ``rank_error``.
    """
    of = sketches.filter(F.col("column") == column)
    names = [PROFILE_QUANTILE_NAMES[p] for p in PROFILE_PROBS]
    wide = wide_quantiles(merged_quantiles(of, PROFILE_PROBS), PROFILE_PROBS, names)
    # One row on either side.
    wide = merged_summary(of).join(wide, "column").withColumn("IQR (q3-q1)", F.col("`q3 (75%)`") - F.col("`q1 (25%)`"))
    metrics = [F.struct(F.lit(i).alias("ord"), F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value"))
               for i, m in enumerate(PROFILE_ORDER)]
    return wide.select(F.inline(F.array(*metrics)))


def merged_ranks(sketches: DataFrame, values: list[float], by: list[str] | None = None) -> DataFrame:
    """``(by..., column, value, share, n)``: the share of rows at or below each value, within ``rank_error``."""
    share: list[Column] = [F.struct(F.lit(float(v)).alias("value"), F.kll_sketch_get_rank_double("sketch", F.lit(float(v)))
                                    .alias("share")) for v in values]
    return _merged(sketches, by or []).select(*(by or []), "column", "n", F.inline(F.array(*share))) \
        .select(*(by or []), "column", "value", "share", "n")


def ranks_within(df: DataFrame, found: DataFrame, error: float) -> DataFrame:
    """``(column, probability, n, within)``: quantiles checked against ranks counted in ``df`` (one pass over its rows).

    ``found`` holds columns x probabilities rows.
    """
    columns = [r["column"] for r in found.select("column").distinct().collect()]
    values = long_values(df, columns).join(F.broadcast(found.select("column", "probability", "value")), "column")
    ranks = values.groupBy("column", "probability").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("value")).alias("below"),
        F.count_if(F.col("v") <= F.col("value")).alias("upto"))
    goal, slack = F.col("probability") * F.col("n"), F.lit(error) * F.col("n") + 1
    within = (F.col("below") <= goal + slack) & (F.col("upto") >= goal - slack)
    return ranks.select("column", "probability", "n", within.alias("within"))
