"""Sampling and splitting.

``sample``/``randomSplit`` draw per partition, so their rows change when the
input's partitioning changes; the ``hash_*`` twins decide each row from an
``md5`` of its key columns and give the same rows on any cluster layout (and
in the DuckDB oracle).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.expressions import hash_fraction_predicate, hash_unit
from ontime.sources.sinks import cut_lineage, written


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, fraction: float, keys: list[str]) -> DataFrame:
    """Rows whose key hash falls under ``fraction`` (O5, layout independent)."""
    return df.filter(hash_fraction_predicate(fraction, *keys))


def hash_split(df: DataFrame, test_fraction: float, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Train/test split by key hash (O9): disjoint, complete, repeatable.

    Rows with equal keys land on the same side, which keeps duplicates of a
    record out of both halves.
    """
    is_test = hash_fraction_predicate(test_fraction, *keys)
    return df.filter(~is_test), df.filter(is_test)


def hash_split_written(df: DataFrame, test_fraction: float, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``hash_split`` of a frame whose halves are passed over more than once.

    The rows are computed and hashed once and written by half to the shared
    scratch folder; every pass then reads its half's files alone.
    """
    column = "split"
    while column in [c.lower() for c in df.columns]:
        column += "_"
    rows = written(split_labelled(df, test_fraction, keys, column), "split", [column])
    return tuple(rows.filter(F.col(column) == side).drop(column) for side in ("train", "test"))


def split_labelled(df: DataFrame, test_fraction: float, keys: list[str], column: str = "split") -> DataFrame:
    """The hash split as one frame with a ``train``/``test`` column."""
    is_test = hash_fraction_predicate(test_fraction, *keys)
    return df.withColumn(column, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` as the reference used it."""
    return df.randomSplit(weights, seed=seed)


#: Bits of the key hash, and of the prefix its first histogram is over.
HASH_BITS, PREFIX_BITS = 32, 16


def sample_exact_n(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Exactly ``min(n, rows)`` rows with the smallest key hashes (O8); a sampling operator.

    A histogram of hash prefixes (65,536 counts) finds the prefix in which the
    n-th smallest hash lies, a second one inside that prefix the hash itself.
    Every row with a smaller hash is kept where it is; only rows of that very
    hash are ranked, by every column, so the result does not depend on row
    order.  No task merges the sample, however large ``n`` is.  Rows with null
    keys have a hash like any other.  The sample is in no particular order.
    """
    h = hash_unit(*keys)
    return _smallest(df, h, n, _histogram(df, F.shiftright(h, HASH_BITS - PREFIX_BITS)))


def _histogram(df: DataFrame, bucket: Column) -> list[tuple[int, int]]:
    """(bucket, rows) in bucket order; at most ``2^PREFIX_BITS`` rows."""
    return sorted((r["b"], r["count"]) for r in df.groupBy(bucket.alias("b")).count().collect())


def _cut(histogram: list[tuple[int, int]], n: int) -> tuple[int, int, int] | None:
    """(bucket that holds the n-th row, rows below it, rows in it), None with fewer rows."""
    below = 0
    for bucket, rows in histogram:
        if below + rows >= n:
            return bucket, below, rows
        below += rows
    return None


def _smallest(df: DataFrame, h: Column, n: int, prefixes: list[tuple[int, int]]) -> DataFrame:
    if n <= 0:
        return df.limit(0)
    found = _cut(prefixes, n)
    if found is None:
        return df
    prefix, below, _ = found
    rest = HASH_BITS - PREFIX_BITS
    inside = df.filter(F.shiftright(h, rest) == prefix)
    low, more, equal = _cut(_histogram(inside, h.bitwiseAND(F.lit((1 << rest) - 1))), n - below)
    bound, wanted = (prefix << rest) + low, n - below - more
    if wanted == equal:
        return df.filter(h <= F.lit(bound))
    return df.filter(h < F.lit(bound)).unionByName(_first_rows(df.filter(h == F.lit(bound)), wanted))


def _first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in order of all columns (nulls first): sorted by ranges, whole ranges kept in place."""
    ordered = cut_lineage(df.repartitionByRange(*df.columns).sortWithinPartitions(*df.columns))
    at = F.monotonically_increasing_id()  # number of the partition, then of the row in it
    part, row = F.shiftright(at, 33), at.bitwiseAND(F.lit((1 << 33) - 1))
    found = _cut(_histogram(ordered, part), n)
    if found is None:
        return ordered
    last, below, _ = found
    numbered = ordered.select("*", part.alias("__part"), row.alias("__row"))
    return numbered.filter((F.col("__part") < last) | ((F.col("__part") == last) & (F.col("__row") < n - below))) \
        .drop("__part", "__row")


def sample_or_limit(df: DataFrame, fraction: float, max_rows: int, keys: list[str]) -> DataFrame:
    """A hash-ordered sample of stated size (O6, O7): ``min(max_rows, ceil(fraction * rows))`` rows, at least one.

    One rule at every input size: no emptiness test, no prefix of the input.
    An empty input gives an empty sample.
    """
    h = hash_unit(*keys)
    prefixes = _histogram(df, F.shiftright(h, HASH_BITS - PREFIX_BITS))
    rows = sum(n for _, n in prefixes)
    return _smallest(df, h, min(max_rows, max(1, math.ceil(fraction * rows))), prefixes)
