"""Exact and approximate quantiles that stay distributed.

``percentile``/``percentile_disc`` keep every distinct value of a group in one
aggregation buffer, so a single task holds the whole column.  The exact path
here never does that:

1. value counts ``(column, v) -> n`` (partial aggregation before the shuffle,
   so a value that holds a third of the rows is one row afterwards), kept
   (memory, spilling to disk) for the duration of the step so the source is
   scanned once;
2. approximate bucket bounds over the distinct values (one small job, at most
   ``buckets`` doubles per column come back to the driver);
3. per-bucket totals and their running sum (``buckets`` rows per column);
4. a bucket that contains a target rank and more than ``ROW_BUDGET`` distinct
   values is cut again;
5. only the buckets that contain a target rank are joined back (broadcast of
   at most one row per target) and ranked with a window inside the bucket.
   Infinities are values like any other, in the outermost buckets.

The answer is the smallest value whose cumulative count reaches the target
rank, which is the SQL ``percentile_disc`` definition; ``percentile_cont``
interpolates between two such ranks.  The step is eager (like
``approxQuantile``): it returns its few result rows (columns x targets) as a
small DataFrame and releases the cached counts.  The approximate path is one
``percentile_approx`` aggregate (``tidy_profile(exact=False)``): the full
(column, value) shuffle is the price of exactness, so use it at 100 TB.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.expressions import is_valid_number

#: Buckets a column's values are first cut into; distinct values one task may rank.
DEFAULT_BUCKETS = 512
ROW_BUDGET = 100_000


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, v)`` rows of the numeric columns, nulls and NaN removed."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([], columns, "column", "v")
    return long.filter(is_valid_number("v"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, v) -> n`` with ``column`` as the int position in ``columns``.

    An int key keeps the shuffled and cached rows small; names come back only
    on the final, tiny result.
    """
    idx = [str(i) for i in range(len(columns))]
    wide = df.select(*[F.col(c).cast("double").alias(i) for c, i in zip(columns, idx)])
    long = (wide.unpivot([], idx, "column", "v")
                .select(F.col("column").cast("int").alias("column"), "v")
                .filter(is_valid_number("v")))
    return long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))


def _key(i: int, row: str = "v") -> Column:
    return F.when(F.col("column") == F.lit(i), F.col(row))


def _finite(c: str = "v") -> Column:
    return (F.col(c) > F.lit(-math.inf)) & (F.col(c) < F.lit(math.inf))


def _split_points(vc: DataFrame, buckets: int) -> dict[int, list[float]]:
    """Approximate ``buckets``-quantiles of the distinct finite values, by column."""
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    rows = (vc.filter(_finite()).groupBy("column")
              .agg(F.percentile_approx("v", probs, max(10_000, 4 * buckets)).alias("b")).collect())
    return {r["column"]: sorted(set(r["b"] or [])) for r in rows}


def rank_values(df: DataFrame, columns: list[str], targets: dict[str, callable],
                buckets: int = DEFAULT_BUCKETS, row_budget: int = ROW_BUDGET) -> DataFrame:
    """For each column and target, the smallest value whose cumulative count reaches it.

    ``targets`` maps an output name to a function of the column's valid row
    count (a Column) returning the target rank as a double.  Output: one row
    per column with ``total_n`` and one column per target.
    """
    if not columns:
        raise ValueError("no columns")
    vc = value_counts(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return rank_values_from_counts(vc, columns, targets, buckets, row_budget)
    finally:
        vc.unpersist()


def rank_values_from_counts(vc: DataFrame, columns: list[str], targets: dict[str, callable],
                            buckets: int = DEFAULT_BUCKETS, row_budget: int = ROW_BUDGET) -> DataFrame:
    """``rank_values`` over already computed (and ideally cached) value counts.

    A bucket that holds a target and more than ``row_budget`` distinct values
    is split again before it is ranked, until none does.
    """
    bounds = _split_points(vc, buckets)
    while True:
        vcb = _bucketed(vc, columns, bounds)
        hits = _hit_buckets(vcb, targets)
        wide = hits.filter(F.col("values") > row_budget).select("column", "bucket", "values").collect()
        if not wide:
            break
        inside = vcb.join(F.broadcast(hits.filter(F.col("values") > row_budget).select("column", "bucket")),
                          ["column", "bucket"]).select("column", "v", "n")
        finer = _split_points(inside, max(2, buckets, -(-2 * max(r["values"] for r in wide) // row_budget)))
        more = {i: sorted({*bounds.get(i, []), *finer.get(i, [])}) for i in range(len(columns))}
        if more == {i: bounds.get(i, []) for i in range(len(columns))}:
            break  # one value, or infinities only: nothing left to split
        bounds = more
    rows = _rank_plan(vcb, hits, targets).collect()
    schema = "column string, total_n bigint, " + ", ".join(f"`{k}` double" for k in targets)
    named = [(columns[r[0]],) + tuple(r)[1:] for r in rows]
    return vc.sparkSession.createDataFrame(named, schema)


def summary_from_counts(vc: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample stddev, min, max per column from value counts (eager, k rows).

    The mean is the count-weighted sum; the variance is a second pass of
    count-weighted squared deviations from it (two-pass, stable).  Both passes
    read the value counts, not the source.
    """
    first = (vc.groupBy("column")
               .agg(F.sum("n").alias("count"), F.sum(F.col("n") * F.col("v")).alias("sv"),
                    F.min("v").alias("min"), F.max("v").alias("max"))
               .withColumn("mean", F.col("sv") / F.col("count")))
    means = {r["column"]: r for r in first.collect()}
    dev = F.col("v")
    for i, r in means.items():
        dev = F.when(F.col("column") == F.lit(i), F.col("v") - F.lit(r["mean"])).otherwise(dev)
    ss = {r["column"]: r["ss"] for r in
          vc.groupBy("column").agg(F.sum(F.col("n") * dev * dev).alias("ss")).collect()}
    out = []
    for i, c in enumerate(columns):
        r = means.get(i)
        if r is None:
            out.append((c, 0, None, None, None, None))
            continue
        n = r["count"]
        sd = math.sqrt(ss[i] / (n - 1)) if n > 1 else None
        out.append((c, n, r["mean"], sd, r["min"], r["max"]))
    return vc.sparkSession.createDataFrame(
        out, "column string, count bigint, mean double, stddev double, min double, max double")


def _bucketed(vc: DataFrame, columns: list[str], bounds: dict[int, list[float]]) -> DataFrame:
    """Value counts with their bucket: one multi-column Bucketizer, each row against its own column's splits."""
    splits = [[-math.inf] + (bounds.get(i, []) or [0.0]) + [math.inf] for i in range(len(columns))]
    ins = [f"_v{i}" for i in range(len(columns))]
    outs = [f"_b{i}" for i in range(len(columns))]
    wide = vc.withColumns({ins[i]: _key(i).otherwise(F.lit(0.0)) for i in range(len(columns))})
    bucketed = Bucketizer(splitsArray=splits, inputCols=ins, outputCols=outs).transform(wide)
    bucket = F.coalesce(*[_key(i, outs[i]) for i in range(len(columns))])
    return bucketed.select(*vc.columns, bucket.alias("bucket"))


def _hit_buckets(vcb: DataFrame, targets: dict[str, callable]) -> DataFrame:
    """Buckets that hold a target rank: at most one row per column and target."""
    by_col = Window.partitionBy("column")  # at most as many rows as buckets
    running = by_col.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (vcb.groupBy("column", "bucket").agg(F.sum("n").alias("bn"), F.count(F.lit(1)).alias("values"))
                 .withColumn("end", F.sum("bn").over(running))
                 .withColumn("total_n", F.sum("bn").over(by_col))
                 .withColumn("start", F.col("end") - F.col("bn")))
    tcols = {name: F.greatest(fn(F.col("total_n")).cast("double"), F.lit(1.0)) for name, fn in targets.items()}
    totals = totals.withColumns({f"t_{k}": v for k, v in tcols.items()})
    hit = reduce(lambda a, b: a | b, [(F.col("start") < F.col(f"t_{k}")) & (F.col(f"t_{k}") <= F.col("end"))
                                      for k in targets])
    return totals.filter(hit).drop("bn", "end")


def _rank_plan(vcb: DataFrame, hits: DataFrame, targets: dict[str, callable]) -> DataFrame:
    # At most one bucket per target and column: a bounded broadcast.
    ranked = vcb.join(F.broadcast(hits), ["column", "bucket"])
    within = Window.partitionBy("column", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding,
                                                                             Window.currentRow)
    ranked = ranked.withColumn("cum", F.col("start") + F.sum("n").over(within))
    aggs = [F.first("total_n").alias("total_n")]
    aggs += [F.min(F.when(F.col("cum") >= F.col(f"t_{k}"), F.col("v"))).alias(k) for k in targets]
    return ranked.groupBy("column").agg(*aggs)


def _pname(p: float) -> str:
    return f"p{int(round(p * 1_000_000)):07d}"


def quantiles_disc(df: DataFrame, columns: list[str], probs: list[float],
                   buckets: int = DEFAULT_BUCKETS, counts: DataFrame | None = None,
                   row_budget: int = ROW_BUDGET) -> DataFrame:
    """Exact ``percentile_disc``; long form ``(column, probability, value)``.

    ``counts``: value counts already computed by ``value_counts`` (cached by
    the caller), so several statistics can share one source scan.
    """
    targets = {_pname(p): (lambda N, p=p: N.cast("double") * F.lit(float(p))) for p in probs}
    if counts is not None:
        wide = rank_values_from_counts(counts, columns, targets, buckets, row_budget)
    else:
        wide = rank_values(df, columns, targets, buckets, row_budget)
    st = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col(_pname(p)).alias("value")) for p in probs])
    return wide.select("column", F.inline(st))


def quantiles_cont(df: DataFrame, columns: list[str], probs: list[float],
                   buckets: int = DEFAULT_BUCKETS, counts: DataFrame | None = None,
                   row_budget: int = ROW_BUDGET) -> DataFrame:
    """Exact ``percentile_cont`` (linear interpolation, as pandas ``quantile``).

    ``counts``: precomputed value counts, as for ``quantiles_disc``.
    """
    targets = {}
    for p in probs:
        rn = lambda N, p=p: (N.cast("double") - 1.0) * F.lit(float(p))
        targets[_pname(p) + "_lo"] = lambda N, rn=rn: F.floor(rn(N)) + 1.0
        targets[_pname(p) + "_hi"] = lambda N, rn=rn: F.ceil(rn(N)) + 1.0
    if counts is not None:
        wide = rank_values_from_counts(counts, columns, targets, buckets, row_budget)
    else:
        wide = rank_values(df, columns, targets, buckets, row_budget)
    structs = []
    for p in probs:
        rn = (F.col("total_n").cast("double") - 1.0) * F.lit(float(p))
        frac = rn - F.floor(rn)
        lo, hi = F.col(_pname(p) + "_lo"), F.col(_pname(p) + "_hi")
        structs.append(F.struct(F.lit(float(p)).alias("probability"), (lo + (hi - lo) * frac).alias("value")))
    return wide.select("column", F.inline(F.array(*structs)))


def quantiles_approx(df: DataFrame, columns: list[str], probs: list[float],
                     relative_error: float = 0.001) -> DataFrame:
    """One ``percentile_approx`` pass (A4); rank error at most ``relative_error * N``."""
    acc = max(1, int(round(1.0 / relative_error)))
    long = long_values(df, columns)
    agg = long.groupBy("column").agg(F.percentile_approx("v", [float(p) for p in probs], acc).alias("q"))
    return agg.select("column", F.posexplode("q").alias("i", "value")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("probability"),
        "value")


def wide_quantiles(long: DataFrame, probs: list[float], names: list[str]) -> DataFrame:
    """Pivot long quantiles to one row per column with the given names."""
    return long.groupBy("column").agg(
        *[F.first(F.when(F.col("probability") == F.lit(float(p)), F.col("value")), ignorenulls=True).alias(n)
          for p, n in zip(probs, names)])


def bounds_for(df: DataFrame, column: str, lo_p: float, hi_p: float, exact: bool = True) -> tuple[float, float]:
    """Two quantiles of one column as Python floats (two values to the driver)."""
    if exact:
        q = quantiles_cont(df, [column], [lo_p, hi_p])
    else:
        q = quantiles_approx(df, [column], [lo_p, hi_p])
    got = {r["probability"]: r["value"] for r in q.collect()}
    return got.get(lo_p), got.get(hi_p)


def winsorize(df: DataFrame, column: str, lo_p: float = 0.01, hi_p: float = 0.99,
              exact: bool = True, output: str | None = None) -> DataFrame:
    """Clip a column to its ``lo_p``/``hi_p`` quantiles (P20, pandas ``clip``)."""
    lo, hi = bounds_for(df, column, lo_p, hi_p, exact)
    x = F.col(column)
    clipped: Column = F.least(F.greatest(x, F.lit(lo)), F.lit(hi)) if lo is not None else x
    return df.withColumn(output or column, clipped)
