"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

1. ``statistics`` counts words, symbols, repeats and so on of each whole text in
   Arrow batches and turns them into a vector (logarithms and arcsine roots).
2. Texts that fail the base rules are rejected; the others of one language and
   source are a group, small groups are pooled with others of their language.
3. Per group the covariance of the ``SHARE`` of rows that gives the least
   determinant is sought from three deterministic starts (identity, tanh
   correlation, spatial signs about the medians) by concentration steps.  A
   step is one Spark aggregate for all groups: rows are binned by Mahalanobis
   distance, each bin keeps its moments, and the innermost bins that hold the
   share make the next estimate.  No rows are sampled or collected and a group
   of any size is summed in parts.
4. One reweighting step, then rows beyond ``CUTOFF`` are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import materialize

#: Base rules: least words, most per cent of words in repeated windows of three.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Rows in the subset of least determinant; concentration steps from each start.
SHARE, STEPS = 0.75, 6
#: Rows a group of its own needs, and below which a pool has no estimate and all its rows stay.
MIN_ROWS, LEAST_ROWS = 200, 30
#: Groups whose models may be broadcast; with more, rows and models meet in a shuffle join.
BROADCAST_GROUPS = 2_000
#: Bins a doubling of the squared distance; distances outside 2^-20 .. 2^40 share the outermost bins.
BINS = 16
# Components of the vector and the spread below which a difference in them means nothing (as a standard deviation).
FLOORS = {"log_words": 0.25, "log_word_length": 0.1, "symbols": 0.05, "capitals": 0.05, "punctuation": 0.05,
          "repeated_lines": 0.15, "repeated_words": 0.15}
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]

# Bytes of blanks, of symbols, of other ASCII punctuation, of ASCII capitals; bytes that continue a character.
BLANK, SYMBOL, CAPITAL = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PUNCTUATION, CONTINUED = b"!\"'()+,-./:;=?@[\\]^_`{}~", bytes(range(0x80, 0xC0))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def chi2_quantile(q: float, p: int = P) -> float:
    """Quantile of the chi-squared distribution by the Wilson-Hilferty approximation."""
    a = 2 / (9 * p)
    return p * (1 - a + NormalDist().inv_cdf(q) * a ** 0.5) ** 3


def chi2_share(x: float, p: int = P) -> float:
    a = 2 / (9 * p)
    return NormalDist().cdf(((x / p) ** (1 / 3) - 1 + a) / a ** 0.5)


def consistency(share: float) -> float:
    """Factor that makes the covariance of the innermost ``share`` of a normal sample that of the whole."""
    return share / chi2_share(chi2_quantile(share), P + 2)


#: Squared distances: rows that count in the reweighting step, rows that stay.
WEIGHED = 0.975
CUTOFF = chi2_quantile(1 - 1e-5)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which the text holds twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=len(words))
    pairs = w[:-1] * len(ids) + w[1:]
    if len(ids) > 1 << 20:  # keeps the window's number within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, times = np.unique(pairs[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    twice = times[at] > 1
    inside = np.zeros(len(words), dtype=bool)
    for k in range(3):
        inside[k:n + k] |= twice
    return int(inside.sum())


def counts(text: bytes) -> list[int]:
    """``COUNTS``, then capitals, other punctuation and lines with a word, of one UTF-8 text."""
    words = text.split()
    chars = text.translate(None, BLANK + CONTINUED)
    lines = [line for line in text.split(b"\n") if line.strip()]
    held = lambda of: len(chars) - len(chars.translate(None, of))
    return [len(words), len(chars), held(SYMBOL), len(lines) - len(set(lines)), repeated_words(words),
            held(CAPITAL), held(PUNCTUATION), len(lines)]


def vectors(c: np.ndarray) -> np.ndarray:
    """Rows of counts as transformed statistics; zeros for a text without words."""
    words, chars, lines = (np.maximum(c[:, k], 1.0) for k in (0, 1, 7))
    root = lambda part, whole: np.arcsin(np.sqrt(np.minimum(part / whole, 1.0)))
    return np.column_stack([np.log(words), np.log(chars / words), root(c[:, 2], chars), root(c[:, 5], chars),
                            root(c[:, 6], chars), root(c[:, 3], lines), root(c[:, 4], words)])


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
               source_column: str = "source") -> DataFrame:
    """(id, lang, source, the counts, x, base_failed) of each row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([counts(t.as_py() or b"") for t in batch.column(3)], dtype=np.int64).reshape(-1, 8)
            x = pa.array(list(vectors(found.astype(float))), type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(found[:, k]) for k in range(5)), x],
                                             names=["id", "lang", "source", *COUNTS, "x"])

    made = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(lang_column).cast("string").alias("lang"),
                       F.col(source_column).cast("string").alias("source"),
                       F.col(text_column).cast("binary").alias("t")).mapInArrow(
        run, "id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", x array<double>")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return made.withColumn("base_failed", failed)


def grouped(stats: DataFrame) -> DataFrame:
    """``stats`` with column ``grp``: language and source, or the pool that small groups share."""
    cells = stats.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n"))
    own = F.col("n") >= MIN_ROWS
    shared = F.sum(F.when(~own, F.col("n"))).over(Window.partitionBy("lang"))
    grp = (F.when(own, F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))))
           .when(shared >= MIN_ROWS, F.concat(F.lit("1"), F.to_json(F.struct("lang")))).otherwise("0"))
    cells = materialize(cells.select(F.col("lang").alias("l"), F.col("source").alias("s"), grp.alias("grp")), "cells")
    return stats.join(_small(cells), F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))).drop("l", "s")


def _small(models: DataFrame) -> DataFrame:
    """For a join: broadcast if there are at most ``BROADCAST_GROUPS`` rows, else as it is."""
    return F.broadcast(models) if models.count() <= BROADCAST_GROUPS else models


def _elements(column: str, size: int = P) -> list[Column]:
    return [F.get(column, F.lit(i)) for i in range(size)]


def standardised(rows: DataFrame) -> DataFrame:
    """Rows with ``z``, the vector about its group's medians in units of their absolute deviations, and ``floor`` in those."""
    x, inner = _elements("x"), rows.filter("NOT base_failed")
    median = lambda c: F.percentile_approx(c, 0.5, 10_000)
    mid = materialize(inner.groupBy("grp").agg(F.array(*[median(c) for c in x]).alias("m"), F.count(F.lit(1)).alias("size"))
                      .withColumnRenamed("grp", "g").filter(F.col("size") >= LEAST_ROWS), "medians")
    about = inner.join(_small(mid), F.col("grp") == F.col("g"))
    wide = about.groupBy("g").agg(F.array(*[median(F.abs(F.get("x", F.lit(i)) - F.get("m", F.lit(i)))) for i in range(P)]).alias("d"))
    least = F.array(*[F.lit(f) for f in FLOORS.values()])
    scale = materialize(mid.join(wide.withColumnRenamed("g", "h"), F.col("g") == F.col("h")).select(
        "g", "m", F.zip_with("d", least, lambda d, f: F.greatest(d * 1.4826, f)).alias("s")), "scales")
    out = rows.join(_small(scale), F.col("grp") == F.col("g"), "left")
    z = F.array(*[(F.get("x", F.lit(i)) - F.get("m", F.lit(i))) / F.get("s", F.lit(i)) for i in range(P)])
    return (out.withColumn("z", F.when(F.col("g").isNotNull(), z))
            .withColumn("floor", F.when(F.col("g").isNotNull(), F.zip_with(least, "s", lambda f, s: f / s))).drop("g", "m", "s"))


def _moments(v: list[Column]) -> list[Column]:
    """Aggregates: rows, sums and sums of products of the vector."""
    return [F.count(F.lit(1)).cast("double").alias("c"), F.array(*[F.sum(a) for a in v]).alias("s1"),
            F.array(*[F.sum(v[i] * v[j]) for i, j in PAIRS]).alias("s2")]


def _models(sums: DataFrame, factor: float, about_zero: bool = False) -> DataFrame:
    """(grp, start, centre, w, logdet) from moments; ``w`` turns a difference into one of unit covariance.

    The floors are added to the covariance, so a component that is constant in the subset is no fault.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.tril_indices(P)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                mean = np.zeros(P) if about_zero else np.array(row["s1"]) / row["c"]
                cov = np.zeros((P, P))
                cov[low] = np.array(row["s2"]) / row["c"]
                cov = (cov + np.tril(cov, -1).T - np.outer(mean, mean)) * factor + np.diag(np.array(row["floor"]) ** 2)
                root = np.linalg.cholesky(cov)
                out.append({"g": row["grp"], "start": row["start"], "centre": mean.tolist(), "floor": row["floor"],
                            "w": np.linalg.inv(root)[low].tolist(), "logdet": 2 * float(np.log(np.diag(root)).sum())})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    of = pa.list_(pa.float64())
    schema = pa.schema([("g", pa.string()), ("start", pa.int32()), ("centre", of), ("floor", of), ("w", of), ("logdet", pa.float64())])
    return sums.select("grp", "start", "c", "s1", "s2", "floor").mapInArrow(
        run, "g string, start int, centre array<double>, floor array<double>, w array<double>, logdet double")


def _distance() -> Column:
    """Squared Mahalanobis distance of ``z`` under the joined model."""
    diff = [F.get("z", F.lit(i)) - F.get("centre", F.lit(i)) for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        part = sum((F.get("w", F.lit(PAIRS.index((i, j)))) * diff[j] for j in range(i + 1)), F.lit(0.0))
        total = total + part * part
    return total


def _starts(inner: DataFrame) -> DataFrame:
    """Models of the three starts: identity, correlation of tanh(z), covariance of spatial signs; all about the medians."""
    z = _elements("z")
    norm = F.sqrt(sum((a * a for a in z), F.lit(0.0)))
    made = [[F.tanh(a) for a in z], [F.coalesce(F.try_divide(a, norm), F.lit(0.0)) for a in z]]
    rows = inner.select("grp", "floor", F.explode(F.array(*[
        F.struct(F.lit(k + 1).alias("start"), F.array(*v).alias("v")) for k, v in enumerate(made)])).alias("y"))
    sums = rows.select("grp", "floor", "y.*").groupBy("grp", "start").agg(F.first("floor").alias("floor"), *_moments(_elements("v")))
    identity = sums.filter("start = 1").withColumns({
        "start": F.lit(0), "s2": F.transform(F.array(*[F.lit(float(i == j)) for i, j in PAIRS]), lambda e: e * F.col("c"))})
    return _models(sums.unionByName(identity), 1.0, about_zero=True)


def _concentrate(inner: DataFrame, models: DataFrame) -> DataFrame:
    """One step: the moments of the ``SHARE`` of rows nearest to each model, as new models."""
    d = _distance()
    near = inner.join(_small(models.drop("floor")), F.col("grp") == F.col("g")).select("grp", "floor", "z", "start", d.alias("d"))
    level = F.when(F.col("d") > 0, F.floor(F.log2("d") * BINS)).otherwise(F.lit(-20 * BINS))
    level = F.least(F.greatest(level, F.lit(-20 * BINS)), F.lit(40 * BINS)).cast("int")
    binned = near.withColumn("bin", level).groupBy("grp", "start", "bin").agg(F.first("floor").alias("floor"), *_moments(_elements("z")))
    one = Window.partitionBy("grp", "start")
    before = F.sum("c").over(one.orderBy("bin")) - F.col("c")
    kept = binned.withColumns({"before": before, "all": F.sum("c").over(one)}).filter(F.col("before") < F.ceil(F.col("all") * SHARE))
    return _models(_summed(kept), consistency(SHARE))


def _summed(parts: DataFrame) -> DataFrame:
    add = lambda c, size: F.array(*[F.sum(e) for e in _elements(c, size)]).alias(c)
    return parts.groupBy("grp", "start").agg(F.first("floor").alias("floor"), F.sum("c").alias("c"), add("s1", P),
                                             add("s2", len(PAIRS)))


def robust_models(inner: DataFrame) -> DataFrame:
    """(g, start, centre, floor, w, logdet): one reweighted estimate of least determinant for each group."""
    models = materialize(_starts(inner), "mcd")
    for _ in range(STEPS):
        models = materialize(_concentrate(inner, models), "mcd")
    best = F.row_number().over(Window.partitionBy("g").orderBy(F.round("logdet", 9), "start"))
    models = materialize(models.withColumn("nth", best).filter("nth = 1").drop("nth"), "mcd")
    near = inner.join(_small(models.drop("floor")), F.col("grp") == F.col("g")).filter(_distance() <= chi2_quantile(WEIGHED))
    sums = near.groupBy("grp", "start").agg(F.first("floor").alias("floor"), *_moments(_elements("z")))
    return materialize(_models(sums, consistency(WEIGHED)), "mcd")


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
            source_column: str = "source") -> DataFrame:
    """One row per input row: id, the counts, base_failed, distance (squared), kept.

    The estimates use every row that passes the base rules.  Null languages and
    sources are values like any other; a null or empty text has no words and
    fails the base rules; equal rows get equal results.  In a pool of fewer
    than ``LEAST_ROWS`` such rows nothing is rejected beyond the base rules
    (null distance).  Other columns are left out.
    """
    stats = materialize(statistics(docs, id_column, text_column, lang_column, source_column), "statistics")
    rows = materialize(standardised(materialize(grouped(stats), "groups")), "standardised")
    models = robust_models(rows.filter("z IS NOT NULL AND NOT base_failed").select("grp", "z", "floor"))
    scored = rows.drop("floor").join(_small(models), F.col("grp") == F.col("g"), "left")
    distance = F.when(F.col("g").isNotNull(), _distance())
    return (scored.select(F.col("id").alias(id_column), *COUNTS, "base_failed", distance.alias("distance"))
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)))
