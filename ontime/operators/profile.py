"""Single-scan profiling.

The reference ran one Spark job per statistic (a filter + count per column
for missingness, a separate count for every percentage) and did the rest in
pandas on a sample.  Here each report is one aggregate over the full data
(plus the distributed quantile step where quantiles are asked for), returned
as a small long-form DataFrame.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.expressions import is_missing, is_valid_number, pct
from ontime.sources.sinks import written
from ontime.operators.quantiles import (
    quantiles_approx,
    quantiles_cont,
    quantiles_disc,
    summary_from_counts,
    value_counts,
    wide_quantiles,
)

# Probabilities and metric order of the target profile.
PROFILE_PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
PROFILE_ORDER = ["count", "mean", "stddev", "min", "q1 (1%)", "q5 (5%)", "q1 (25%)", "median (50%)",
                 "q3 (75%)", "IQR (q3-q1)", "q95", "q99", "max"]
PROFILE_QUANTILE_NAMES = {0.01: "q1 (1%)", 0.05: "q5 (5%)", 0.25: "q1 (25%)", 0.5: "median (50%)",
                          0.75: "q3 (75%)", 0.95: "q95", 0.99: "q99"}


def row_count(df: DataFrame) -> DataFrame:
    """``COUNT(*) AS cnt`` (A1)."""
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, ordered by key (A2)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).orderBy(*keys)


def is_empty(df: DataFrame) -> bool:
    """Emptiness test that stops at the first row."""
    return df.isEmpty()


def _valid(c: str):
    x = F.col(c).cast("double")
    return F.when(is_valid_number(x), x)


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample stddev, min, max per column in one pass (A3).

    NaN is treated as missing so one bad value does not turn mean and max into
    NaN.
    """
    structs = [F.struct(F.lit(c).alias("column"),
                        F.count(_valid(c)).alias("count"),
                        F.avg(_valid(c)).alias("mean"),
                        F.stddev_samp(_valid(c)).alias("stddev"),
                        F.min(_valid(c)).alias("min"),
                        F.max(_valid(c)).alias("max")) for c in columns]
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def tidy_profile(df: DataFrame, column: str, exact: bool = True, relative_error: float = 0.001) -> DataFrame:
    """The 13-metric (metric, value) table of one column in a fixed order.

    ``exact=True``: one scan of the source builds the value counts (cached
    for the step); the summary and the exact quantiles are both computed from
    them, and the 13 rows are returned.  ``exact=False``: everything in one
    aggregate with approximate quantiles, lazily.
    """
    names = [PROFILE_QUANTILE_NAMES[p] for p in PROFILE_PROBS]
    if exact:
        vc = value_counts(df, [column]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summ = summary_from_counts(vc, [column])
            q = quantiles_disc(df, [column], PROFILE_PROBS, counts=vc)
            qw = wide_quantiles(q, PROFILE_PROBS, names)
            wide = summ.join(qw, "column", "left")
            wide = wide.withColumn("IQR (q3-q1)", F.col("`q3 (75%)`") - F.col("`q1 (25%)`"))
            rows = _tidy_rows(wide).collect()
        finally:
            vc.unpersist()
        return df.sparkSession.createDataFrame([tuple(r) for r in rows], "ord int, metric string, value double")
    summ = numeric_summary(df, [column])
    q = quantiles_approx(df, [column], PROFILE_PROBS, relative_error)
    qw = wide_quantiles(q, PROFILE_PROBS, names)
    # Both sides hold one row per profiled column: a bounded broadcast.
    wide = summ.join(F.broadcast(qw), "column", "left")
    wide = wide.withColumn("IQR (q3-q1)", F.col("`q3 (75%)`") - F.col("`q1 (25%)`"))
    return _tidy_rows(wide)


def _tidy_rows(wide: DataFrame) -> DataFrame:
    order = {m: i for i, m in enumerate(PROFILE_ORDER)}
    structs = [F.struct(F.lit(order[m]).alias("ord"), F.lit(m).alias("metric"),
                        F.col(f"`{m}`").cast("double").alias("value")) for m in PROFILE_ORDER]
    return wide.select(F.inline(F.array(*structs))).orderBy("ord")


def iqr(df: DataFrame, column: str) -> DataFrame:
    """q25, q75 and their difference (A5)."""
    q = wide_quantiles(quantiles_disc(df, [column], [0.25, 0.75]), [0.25, 0.75], ["q25", "q75"])
    return q.select("column", "q25", "q75", (F.col("q75") - F.col("q25")).alias("iqr"))


def missing_report(df: DataFrame, columns: list[str] | None = None,
                   na_tokens: tuple[str, ...] = ()) -> DataFrame:
    """Missing count and share per column, worst first, in ONE pass.

    Missing is decided by type (D2): null for integral columns, null or NaN
    for floating ones, null or empty text (or ``na_tokens``) for strings.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in set(columns)]
    structs = [F.struct(F.lit(f.name).alias("column"),
                        F.count_if(is_missing(f.name, f.dataType, na_tokens)).alias("n_missing"))
               for f in fields]
    agg = df.agg(F.count(F.lit(1)).alias("total"), F.array(*structs).alias("s"))
    out = agg.select("total", F.inline("s"))
    return (out.select("column", "n_missing", pct(F.col("n_missing"), F.col("total")).alias("pct_missing"))
               .orderBy(F.desc("pct_missing"), "column"))


def five_number_summary(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """min, 25 %, 50 %, 75 %, max per column with numeric types.

    ``exact=True`` computes everything from one cached value-count scan.
    """
    probs = [0.25, 0.5, 0.75]
    if not exact:
        qw = wide_quantiles(quantiles_approx(df, columns, probs), probs, ["q25", "q50", "q75"])
        mm = numeric_summary(df, columns).select("column", "min", "max")
        return mm.join(F.broadcast(qw), "column", "left").select("column", "min", "q25", "q50", "q75", "max")
    return _from_counts(df, columns, lambda vc: quantiles_disc(df, columns, probs, counts=vc), probs,
                        ["column", "min", "q25", "q50", "q75", "max"])


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """pandas-style describe: count, mean, std, min, quartiles (interpolated), max.

    One cached value-count scan feeds both the moments and the quartiles.
    """
    probs = [0.25, 0.5, 0.75]
    return _from_counts(df, columns, lambda vc: quantiles_cont(df, columns, probs, counts=vc), probs,
                        ["column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"])


def _from_counts(df: DataFrame, columns: list[str], quantile_fn, probs: list[float],
                 select: list[str]) -> DataFrame:
    """Summary + quantiles from one cached value-count scan; returns the k result rows."""
    vc = value_counts(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        summ = summary_from_counts(vc, columns).withColumnRenamed("stddev", "std")
        qw = wide_quantiles(quantile_fn(vc), probs, ["q25", "q50", "q75"])
        rows = summ.join(qw, "column", "left").select(*select).collect()
    finally:
        vc.unpersist()
    schema = ", ".join(f"`{c}` {'string' if c == 'column' else 'bigint' if c == 'count' else 'double'}"
                       for c in select)
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], schema)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair (A13, D15), long form ``(col_x, col_y, r)``.

    Rows null or NaN in any of the columns are left out, as the reference's
    ``dropna`` did.  One aggregate finds the constant columns, whose ``r`` is
    null (``corr`` would divide by zero); the others' correlations come from
    Spark ML's packed Gram matrix over an assembled vector, whose cost grows
    with the columns squared inside tight array loops, not with as many SQL
    expressions.  Only the k x k result reaches the driver.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if columns:
        # The range aggregate and the passes of the covariance each read it.  Rows are left out after the write: ahead of
        # it, the filter would be pushed below the columns' expressions and compute them all a second time.
        data = written(data, "correlation")
    data = data.na.drop(how="any")
    spread = data.agg(F.count(F.lit(1)).alias("n"),
                      F.array(*[F.min(c) for c in columns]).alias("lo"),
                      F.array(*[F.max(c) for c in columns]).alias("hi")).first()
    steady = [c for c, lo, hi in zip(columns, spread["lo"], spread["hi"], strict=True) if lo != hi]
    matrix = None
    if spread["n"] > 1 and steady:
        vec = VectorAssembler(inputCols=steady, outputCol="_features").transform(data)
        matrix = Correlation.corr(vec.select("_features"), "_features", "pearson").first()[0].toArray()
    at = {c: i for i, c in enumerate(steady)} if matrix is not None else {}
    out = []
    for a in columns:
        for b in columns:
            r = float(matrix[at[a]][at[b]]) if a in at and b in at else None
            out.append((a, b, None if r is None or math.isnan(r) else r))
    return df.sparkSession.createDataFrame(out, "col_x string, col_y string, r double")


def correlation_pairwise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every unordered pair over the rows where both are real, with their number.

    ``(col_x, col_y, n, r)``.  A task turns its rows into a matrix of values
    about the column means (0 where missing) and a matrix of masks; all pairs'
    counts, sums, squares and products are four matrix products a batch, summed
    over the task and then by pair in one aggregate.  A task holds and sends
    ``len(columns)`` squared numbers however many rows it reads.  ``r`` is null
    without spread or where an infinite value is met; null and NaN are missing.
    """
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    real = [F.when(~F.isnan(c) & (F.abs(F.col(c)) < F.lit(math.inf)), F.col(c)) for c in data.columns]
    means = data.agg(*[F.avg(c).alias(n) for c, n in zip(real, data.columns, strict=True)]).first() if columns else ()
    sums = (data.mapInArrow(_masked_products([m or 0.0 for m in means]), _PAIR_SUMS)
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "odd", "sx", "sy", "sxx", "syy", "sxy")]))
    n = F.col("n").cast("double")
    # A variance lost in the rounding of its sums is none: the column is constant over the pair's rows.
    var_x, var_y = (F.when(v > F.lit(ROUNDING) * n * F.col(ss), v) for v, ss in (
        (n * F.col(ss) - F.col(s) * F.col(s), ss) for s, ss in (("sx", "sxx"), ("sy", "syy"))))
    r = (n * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(var_x) * F.sqrt(var_y))
    names = F.array(*[F.lit(c) for c in columns])
    k = len(columns)
    spine = df.sparkSession.range(k * k).select((F.col("id") / F.lit(max(k, 1))).cast("int").alias("a"),
                                                (F.col("id") % F.lit(max(k, 1))).cast("int").alias("b")).filter("a < b")
    # Both sides hold a row a pair; a pair without common rows has n = 0.
    return (spine.join(sums, (F.col("a") == F.col("i")) & (F.col("b") == F.col("j")), "left")
            .select(F.get(names, F.col("a")).alias("col_x"), F.get(names, F.col("b")).alias("col_y"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.when(F.col("odd") == 0, r).alias("r")))


#: Share of a sum of squares below which a difference of sums is rounding.
ROUNDING = 1e-12
_PAIR_SUMS = "i int, j int, n bigint, odd bigint, sx double, sy double, sxx double, syy double, sxy double"


def _masked_products(means: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's sums for all pairs i < j of its columns, in one batch at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(means)
        total = np.zeros((5, k, k))
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - means
            there, finite = ~np.isnan(x), np.isfinite(x)
            mask, odd, v = there.astype(float), (there & ~finite).astype(float), np.where(finite, x, 0.0)
            # Rows: both there; either infinite; sums and squares of the first; products.
            total += [mask.T @ mask, odd.T @ mask + mask.T @ odd, v.T @ mask, (v * v).T @ mask, v.T @ v]
        i, j = np.triu_indices(k, 1)
        n, odd, s, ss, p = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(n[i, j].astype(np.int64)),
             pa.array(odd[i, j].astype(np.int64)), *(pa.array(a) for a in (s[i, j], s[j, i], ss[i, j], ss[j, i], p[i, j]))],
            names=["i", "j", "n", "odd", "sx", "sy", "sxx", "syy", "sxy"])

    return run


@dataclass(frozen=True)
class Spread:
    """Moments and bounds of one column's finite, clipped values."""
    n: int
    lo: float
    hi: float
    sd: float | None


def clipped_counts(df: DataFrame, columns: list[str], lo_p: float | None = None, hi_p: float | None = None,
                   vc: DataFrame | None = None) -> DataFrame:
    """Value counts ``(column, v, n)`` of finite values, clipped to two quantiles when given (P20).

    ``vc``: counts from ``value_counts`` that the caller has cached.
    """
    vc = value_counts(df, columns) if vc is None else vc
    vc = vc.filter((F.col("v") > F.lit(-math.inf)) & (F.col("v") < F.lit(math.inf)))
    if lo_p is None:
        return vc
    q = quantiles_cont(df, columns, [lo_p, hi_p], counts=vc).collect()
    at = {(r["column"], r["probability"]): r["value"] for r in q}
    v = F.col("v")
    for i, c in enumerate(columns):
        if (c, lo_p) in at:
            v = F.when(F.col("column") == i, F.least(F.greatest(F.col("v"), F.lit(at[c, lo_p])), F.lit(at[c, hi_p]))) \
                .otherwise(v)
    return vc.select("column", v.alias("v"), "n").groupBy("column", "v").agg(F.sum("n").alias("n"))


def spreads(counts: DataFrame, columns: list[str]) -> dict[str, Spread]:
    rows = summary_from_counts(counts, columns).collect()
    return {r["column"]: Spread(r["count"], r["min"], r["max"], r["stddev"]) for r in rows if r["count"]}


def histograms(counts: DataFrame, columns: list[str], bins: int = 80,
               known: dict[str, Spread] | None = None) -> DataFrame:
    """Equal-width histogram of each column from its value counts (A14): all ``bins`` bins, empty ones too.

    ``(column, bin, lo, hi, n)``; the right edge belongs to the last bin; a
    constant column has all rows in bin 1, of width 1.  A column without
    finite values has no bins.
    """
    known = spreads(counts, columns) if known is None else known
    spark, empty = counts.sparkSession, F.lit(None).cast("int")
    b, spine = empty, []
    for i, c in enumerate(columns):
        if c not in known:
            continue
        lo, hi = known[c].lo, known[c].hi
        width = (hi - lo) / bins if hi > lo else 1.0
        raw = F.floor(F.lit(float(bins)) * (F.col("v") - F.lit(lo)) / F.lit(hi - lo)) + 1 if hi > lo else F.lit(1)
        b = F.when(F.col("column") == i, F.least(raw, F.lit(bins)).cast("int")).otherwise(b)
        spine += [(c, i, k + 1, lo + k * width, lo + (k + 1) * width) for k in range(bins)]
    found = counts.select("column", b.alias("bin"), "n").groupBy("column", "bin").agg(F.sum("n").alias("n")) \
        .withColumnsRenamed({"column": "_i", "bin": "_b"})
    frame = spark.createDataFrame(spine, "column string, i int, bin int, lo double, hi double")
    # Both sides hold columns x bins rows.
    return (frame.join(found, (F.col("i") == F.col("_i")) & (F.col("bin") == F.col("_b")), "left")
            .select("column", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
            .orderBy("column", "bin"))


def histogram(df: DataFrame, column: str, bins: int = 80) -> DataFrame:
    """``histograms`` of one column (A14): ``(bin, lo, hi, n)``."""
    return histograms(clipped_counts(df, [column]), [column], bins).drop("column")


#: Standard deviations of the kernel beyond which a value adds nothing at double precision.
KERNEL_REACH = 9.0


def densities(counts: DataFrame, columns: list[str], gridsize: int = 200, cut: float = 3.0,
              bins: int | None = None, known: dict[str, Spread] | None = None) -> DataFrame:
    """Gaussian kernel density of each column on an even grid (A15), Scott's bandwidth, from its value counts.

    ``(column, gi, x, density)``.  Each distinct value adds only to the grid
    points its kernel reaches, through an ``explode`` of their range and a
    ``groupBy`` of ``gridsize`` keys a column (map-side combined).  ``bins``
    first moves values to the centres of that many equal-width bins, which
    bounds the work for continuous columns; the error is below the bin width.
    A column of fewer than two values or without spread has no density.
    """
    known = spreads(counts, columns) if known is None else known
    known = {c: s for c, s in known.items() if s.n > 1 and s.sd}
    per = lambda f: F.coalesce(*[F.when(F.col("column") == i, F.lit(float(f(known[c]))))
                                 for i, c in enumerate(columns) if c in known], F.lit(None).cast("double"))
    band = lambda s: s.sd * s.n ** (-1.0 / 5.0)
    start = lambda s: s.lo - cut * band(s)
    step = lambda s: (s.hi + cut * band(s) - start(s)) / (gridsize - 1)
    rows = counts.select("column", "v", "n", per(band).alias("h"), per(start).alias("g0"), per(step).alias("step"),
                         per(lambda s: 1.0 / (s.n * band(s) * math.sqrt(2.0 * math.pi))).alias("norm"))
    rows = rows.filter(F.col("h").isNotNull())
    if bins:
        low, width = per(lambda s: s.lo), per(lambda s: (s.hi - s.lo) / bins)
        at = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
        rows = (rows.withColumn("v", low + (at + F.lit(0.5)) * width)
                .groupBy("column", "v", "h", "g0", "step", "norm").agg(F.sum("n").alias("n")))
    reach = F.lit(KERNEL_REACH) * F.col("h")
    first = F.greatest(F.ceil((F.col("v") - reach - F.col("g0")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("v") + reach - F.col("g0")) / F.col("step")), F.lit(gridsize - 1)).cast("int")
    grid = rows.select("*", F.explode(F.sequence(first, last)).alias("gi"))
    z = (F.col("g0") + F.col("gi") * F.col("step") - F.col("v")) / F.col("h")
    found = grid.groupBy("column", "gi").agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("s")) \
        .withColumnsRenamed({"column": "_i", "gi": "_g"})
    spine = [(c, i, k, start(known[c]) + k * step(known[c]), 1.0 / (known[c].n * band(known[c]) * math.sqrt(2 * math.pi)))
             for i, c in enumerate(columns) if c in known for k in range(gridsize)]
    frame = counts.sparkSession.createDataFrame(spine, "column string, i int, gi int, x double, norm double")
    return (frame.join(found, (F.col("i") == F.col("_i")) & (F.col("gi") == F.col("_g")), "left")
            .select("column", "gi", "x", (F.coalesce("s", F.lit(0.0)) * F.col("norm")).alias("density"))
            .orderBy("column", "gi"))


#: Greatest second derivative of the standard normal density, in absolute value.
KERNEL_BEND = 1.0 / math.sqrt(2.0 * math.pi)


def binned_counts(df: DataFrame, columns: list[str], known: dict[str, Spread], tolerance: float) -> DataFrame:
    """``(column, v, n)``: each value's weight shared between its two neighbours on an even grid, summed by grid point.

    The grid starts at the least value; its spacing keeps a Gaussian density of
    Scott's bandwidth h within ``tolerance / h`` of that of the values
    themselves: sharing errs by at most spacing^2 / 8 times the kernel's second
    derivative.  Grid points are the keys of one map-side combined aggregate,
    so a continuous column shuffles no more rows than the grid has points.
    """
    parts = []
    for i, c in enumerate(columns):
        s = known.get(c)
        if s is None or s.n < 2 or not s.sd:
            continue
        step = s.sd * s.n ** (-1.0 / 5.0) * math.sqrt(8.0 * tolerance / KERNEL_BEND)
        at = (F.col(f"`{c}`").cast("double") - F.lit(s.lo)) / F.lit(step)
        parts.append(F.struct(F.lit(i).alias("column"), at.alias("at"), F.lit(s.lo).alias("lo"), F.lit(step).alias("step")))
    if not parts:
        return df.sparkSession.createDataFrame([], "column int, v double, n double")
    rows = df.select(F.inline(F.array(*parts))).filter(
        F.col("at").isNotNull() & ~F.isnan("at") & (F.abs(F.col("at")) < F.lit(math.inf)))
    low = F.floor("at")
    share = F.col("at") - low
    ends = F.array(F.struct(low.alias("k"), (F.lit(1.0) - share).alias("w")), F.struct((low + 1).alias("k"), share.alias("w")))
    return (rows.select("column", "lo", "step", F.inline(ends)).filter("w > 0").groupBy("column", "lo", "step", "k")
            .agg(F.sum("w").alias("n")).select("column", (F.col("lo") + F.col("k") * F.col("step")).alias("v"), "n"))


def densities_binned(df: DataFrame, columns: list[str], gridsize: int = 200, cut: float = 3.0,
                     tolerance: float = 1e-7) -> DataFrame:
    """``densities`` without counting distinct values (A15): two scans, work bounded by the grids for any column.

    One aggregate gives count, bounds and deviation of each column's finite
    values, ``binned_counts`` the weights that the kernel is summed over.
    """
    known = finite_spreads(df, columns)
    return densities(binned_counts(df, columns, known, tolerance), columns, gridsize, cut, known=known)


def finite_spreads(df: DataFrame, columns: list[str]) -> dict[str, Spread]:
    """``Spread`` of each column's finite values, by one aggregate."""
    finite = {c: F.when(F.abs(F.col(f"`{c}`").cast("double")) < F.lit(math.inf), F.col(f"`{c}`").cast("double")) for c in columns}
    row = df.agg(*[F.struct(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.stddev_samp(v).alias("sd"))
                   .alias(f"s{i}") for i, v in enumerate(finite.values())]).first()
    return {c: Spread(**row[f"s{i}"].asDict()) for i, c in enumerate(columns) if row[f"s{i}"]["n"]}


def kde_grid(df: DataFrame, column: str, gridsize: int = 200, cut: float = 3.0,
             bins: int | None = None) -> DataFrame:
    """``densities`` of one column (A15): ``(gi, x, density)``."""
    return densities(clipped_counts(df, [column]), [column], gridsize, cut, bins).drop("column")
