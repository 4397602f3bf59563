"""Bucket shares and grouped delay rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.expressions import delay_bucket, delayed_flag, pct
from ontime.schema import LABEL


def bucket_summary(df: DataFrame, target: str = LABEL, unknown_bucket: bool = True) -> DataFrame:
    """Rows and share per delay bucket, most frequent first.

    One job: a partial-aggregated ``groupBy`` of at most five keys; the total
    for the share is a window over those few aggregated rows.
    """
    counted = (df.groupBy(delay_bucket(target, unknown_bucket).alias("delay_bucket"))
                 .agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return (counted.withColumn("pct", pct(F.col("n"), total))
                   .orderBy(F.desc("n"), "delay_bucket"))


def delay_rate_overall(df: DataFrame, target: str = LABEL) -> DataFrame:
    """total, delayed and percent delayed in one aggregate."""
    return (df.agg(F.count(F.lit(1)).alias("total"), F.sum(delayed_flag(target)).alias("delayed"))
              .withColumn("pct_delayed", pct(F.col("delayed"), F.col("total"))))


def rate_by(df: DataFrame, keys: list[str], target: str = LABEL) -> DataFrame:
    """Rows, delayed rows and rate per key, worst first."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n"), F.sum(delayed_flag(target)).alias("delayed"))
              .withColumn("pct_delayed", pct(F.col("delayed"), F.col("n")))
              .orderBy(F.desc("pct_delayed"), *keys))


def top_by_rate(df: DataFrame, key: str, k: int, target: str = LABEL) -> DataFrame:
    """The ``k`` keys with the highest delay rate (O3); a top-k report."""
    return rate_by(df, [key], target).limit(k)


def rate_grouping_sets(df: DataFrame, keys: list[str], target: str = LABEL) -> DataFrame:
    """Overall rate and the rate by each key from ONE scan (A8 + A9).

    ``GROUPING SETS ((), (k1), (k2), ...)``: Spark expands each row once per
    set and aggregates them in one shuffle; ``level`` names the set.
    """
    sets = [[]] + [[k] for k in keys]
    g = df.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).alias("gid"),
        F.count(F.lit(1)).alias("n"),
        F.sum(delayed_flag(target)).alias("delayed"))
    level = F.lit("overall")
    full = (1 << len(keys)) - 1
    for i, k in enumerate(keys):
        # grouping_id has bit (len-1-i) cleared when key i is grouped.
        gid_k = full & ~(1 << (len(keys) - 1 - i))
        level = F.when(F.col("gid") == gid_k, F.lit(k)).otherwise(level)
    return (g.withColumn("level", level).drop("gid")
             .withColumn("pct_delayed", pct(F.col("delayed"), F.col("n"))))


def top_groups(df: DataFrame, key: str, k: int = 10, target: str = LABEL,
               min_rows: int = 1) -> DataFrame:
    """Groups with the highest mean delay and their size (X1); a top-k report."""
    return (df.groupBy(key)
              .agg(F.avg(target).alias("avg_delay"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= min_rows)
              .orderBy(F.desc("avg_delay"), key)
              .limit(k))


def enrich(fact: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left") -> DataFrame:
    """Attach dimension columns to facts.

    No broadcast is forced: AQE picks the join from the real shuffle sizes and
    splits a key that holds a large share of the facts.  Duplicate dimension
    keys would multiply facts, so of each key one dimension row joins: the
    first in the order of its other columns.
    """
    keys = [on] if isinstance(on, str) else list(on)
    rest = [c for c in dim.columns if c not in keys]
    if rest:
        dim = (dim.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_row"))
               .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))
    else:
        dim = dim.distinct()
    return fact.join(dim, keys, how)
