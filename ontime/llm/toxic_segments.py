"""Toxicity by maximum-scoring segments of token log-odds.

1. ``fit``: from a bounded sample of labelled rows, one of each family of
   copies, the documents of either class that hold a feature are counted.
   Features are a word's prefixes and the word itself, hashed.  Down that chain
   each count pair is smoothed by a Dirichlet prior centred on the shorter
   feature's share, so an inflected form leans on its stem and a form of its
   own departs from it.  A word's score is the lower confidence bound of its
   log-odds, less ``DRIFT``: only words several times as common in toxic texts
   score above zero, those that merely follow a language or topic do not.
2. ``Model.segments``: one linear pass (Ruzzo-Tompa) finds all maximal
   scoring segments of a document's words.
3. Extreme values: for random text the best segment of n words follows a
   Gumbel law with location ln(K n) / lambda.  lambda solves
   E[exp(lambda s)] = 1 over the clean words, K is the rate at which they begin
   a segment; a logistic calibration of -ln E (E: segments so good expected by
   chance) and of the further segments gives a probability.  All three are
   fitted on sampled rows kept out of the counts.

The feature space has CELLS cells, so the model's size is bounded whatever
the corpus; documents are scored where they are read, without shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import materialize

FEATURE_BITS = 21
CELLS = 2 << FEATURE_BITS
PREFIXES = (4, 5, 6, 7)
#: Labelled documents that must hold a feature.
MIN_DOCUMENTS = 2
#: Labelled rows used at most, of each class; a third of them only calibrates.
ROWS_PER_CLASS = 12_000
#: Weight of the prior in documents; standard errors taken off the log-odds; log-odds a word needs to score.
PRIOR = 5.0
ERRORS = 2.0
DRIFT = math.log(4)
#: Expected number of random segments as good below which a passage is reported.
REPORT_EXPECTED = 0.05
THRESHOLD = 0.7
CACHE_WORDS = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(word: str) -> list[tuple[int, int]]:
    """Cells of a word's prefixes and of the word, shortest first: two hashes each into the feature space."""
    mask = (1 << FEATURE_BITS) - 1
    names = [word[:k] for k in PREFIXES if len(word) >= k] + [f"{word}$"]
    hashes = [xxhash.xxh64_intdigest(n, 7) for n in names]
    return [(h & mask, ((h >> 32) & mask) + mask + 1) for h in hashes]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), linear time; runs of one sign are joined first."""
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    cut = np.flatnonzero(np.diff(up) > 1)
    starts, ends = up[np.r_[0, cut + 1]], up[np.r_[cut, len(up) - 1]] + 1
    held: list[list[float]] = []  # start, end, sum before, sum after
    back: list[int] = []          # for each held segment: the nearest before it with a smaller sum before
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        seg = [s, e, sums[s], sums[e]]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= seg[2]:
                j = back[j]
            if j < 0 or held[j][3] >= seg[3]:
                held.append(seg)
                back.append(j)
                break
            seg = [held[j][0], seg[1], held[j][2], seg[3]]
            del held[j:], back[j:]
    return [(int(a), int(b), float(y - x)) for a, b, x, y in held]


class Model:
    """Cell scores, lambda and calibration; small and of bounded size."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> None:
        self.toxic, self.clean = (np.minimum(x, 65535).astype(np.uint16) for x in (toxic, clean))
        self.share = min(max(n_toxic / max(n_toxic + n_clean, 1), 1e-6), 1 - 1e-6)
        # Gumbel law of clean text: lambda, and segments begun per word (K); coefficients of the calibration.
        self.rate, self.k = 1.0, 1.0
        self.coefficients = np.array([-20.0, 0.0, 0.0])

    def word_score(self, word: str) -> float:
        q, a, b = self.share, 1.0, 1.0
        for one, two in features(word):
            # Of the two cells the smaller count is nearer to the feature's own.
            t, c = min(int(self.toxic[one]), int(self.toxic[two])), min(int(self.clean[one]), int(self.clean[two]))
            if t + c:
                a, b = t + PRIOR * q + 0.5, c + PRIOR * (1 - q) + 0.5
                q = a / (a + b)
        odds = math.log(q / (1 - q)) - math.log(self.share / (1 - self.share))
        return max(odds - ERRORS * math.sqrt(1 / a + 1 / b), 0) - DRIFT if odds > 0 else odds - DRIFT

    def scores(self, words: list[str], known: dict[str, float]) -> np.ndarray:
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.word_score(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.float64, count=len(words))

    def describe(self, text: str | None, known: dict[str, float]) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """Calibration features and reported segments.

        Features: 1; -ln E, at least 0, of the best segment; ln(1 + lambda * score of the others).  E = K n
        exp(-lambda s) is the number of segments that good expected in so many clean words.
        """
        words = words_of(text)
        segments = maximal_segments(self.scores(words, known))
        level = math.log(self.k * max(len(words), 1))
        surprise = [self.rate * s[2] - level for s in segments]
        found = [s for s, x in zip(segments, surprise, strict=True) if x >= -math.log(REPORT_EXPECTED)]
        best = max((s[2] for s in segments), default=0.0)
        others = sum(s[2] for s in segments) - best
        return np.array([1.0, max([0.0, *surprise]), math.log1p(self.rate * others)]), found

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients, -60, 60)))


def _rate(scores: np.ndarray) -> float:
    """lambda in (0, 1] with E[exp(lambda s)] = 1; 1, that of plain log-odds, where the drift makes that sum smaller."""
    if not len(scores) or scores.mean() >= 0 or np.exp(scores).mean() <= 1:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if np.exp(mid * scores).mean() < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Ridge-regularised logistic coefficients by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(labels: DataFrame, id_column: str, label_column: str,
                    rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """At most ``rows_per_class`` ids of either label, by hash order: id, y, counts (else calibrates)."""
    rows = (labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
            .groupBy(F.col(id_column).cast("bigint").alias("id")).agg(F.max(label_column).cast("int").alias("y"))
            .withColumn("h", F.xxhash64("id")))
    parts = [rows.filter(c).orderBy("h", "id").limit(rows_per_class) for c in (F.col("y") == 1, F.col("y") != 1)]
    return parts[0].unionByName(parts[1]).select("id", "y", (F.pmod("h", F.lit(3)) != 0).alias("counts"))


def _family(text: str | None, words: int = 5) -> int:
    """Smallest shingle hash of a text: copies and most near copies share it."""
    w = words_of(text)
    grams = map(" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [" ".join(w)]
    return min(map(xxhash.xxh64_intdigest, grams)) >> 1


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", training: Column | None = None,
        rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Learn from labelled documents; ``training`` (on ``labels``) says which labels may be used.

    Null ids, labels and texts are left out; an id labelled more than once
    counts as its largest label.  Without rows of both classes the model
    scores everything close to 0.
    """
    labels = labels.filter(training) if training is not None else labels
    # At most 2 * rows_per_class small rows: bounded broadcasts.
    sample = F.broadcast(labelled_sample(labels, id_column, label_column, rows_per_class))
    rows = (docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("t"))
            .join(sample, "id"))

    def families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([_family(t) for t in batch.column(0).to_pylist()], pa.int64())],
                names=["id", "family"])

    named = rows.select("t", "id").mapInArrow(families, "id bigint, family bigint")
    ones = materialize(named.groupBy("family").agg(F.min("id").alias("id")).select("id").distinct(), "families")
    sample = F.broadcast(materialize(sample.join(ones, "id", "left_semi"), "sample"))
    rows = (docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("t"))
            .join(sample, "id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, CELLS + 1), dtype=np.int32)  # by class and part; the last cell counts documents
        for batch in batches:
            for t, y, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {cell for word in set(words_of(t)) for both in features(word) for cell in both}
                sums[2 * (not counts) + (y != 1), [*own, CELLS]] += 1
        cells = np.flatnonzero(sums.any(axis=0))
        for low in range(0, len(cells), 65536):
            c = cells[low:low + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(c), *(pa.array(sums[i, c].astype(np.int64)) for i in range(4))],
                                             names=["cell", *parts])

    parts = ["toxic", "clean", "held_toxic", "held_clean"]
    cells = (rows.select("t", "y", "counts").mapInArrow(count, "cell bigint, " + ", ".join(f"{c} bigint" for c in parts))
             .groupBy("cell").agg(*(F.sum(c).alias(c) for c in parts))
             .filter(" + ".join(parts) + f" >= {MIN_DOCUMENTS}"))
    table = cells.toArrow()  # at most CELLS + 1 rows
    counts = np.zeros((4, CELLS + 1), dtype=np.int64)
    for k, c in enumerate(parts):
        counts[k, table["cell"].to_numpy()] = table[c].to_numpy()
    model = Model(counts[0, :-1], counts[1, :-1], int(counts[0, -1]), int(counts[1, -1]))
    if not counts[0, -1] or not counts[1, -1]:
        return model

    def clean_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = model.scores(words_of(t), known) if y != 1 else np.zeros(0)
                part = Counter(np.round(s, 2).tolist())
                yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.float64()),
                                                  pa.array(list(part.values()), pa.int64())], names=["s", "n"])

    held = rows.filter(~F.col("counts")).select("t", "y")
    spread = held.mapInArrow(clean_scores, "s double, n bigint").groupBy("s").agg(F.sum("n").alias("n")).toArrow()
    if spread.num_rows:
        s, n = spread["s"].to_numpy(), spread["n"].to_numpy()
        parts = np.maximum((n / n.sum() * 200_000).astype(int), 1)
        model.rate = _rate(np.repeat(s, parts))
        model.k = float((n[s > 0].sum() + 0.5) / (n.sum() + 1))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            x = np.array([model.describe(t, known)[0] for t in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(3)), batch.column(1)],
                                             names=["a", "b", "c", "y"])

    found = held.mapInArrow(describe, "a double, b double, c double, y int").toArrow()
    y = (found["y"].to_numpy() == 1).astype(float)
    if 0 < y.sum() < len(y):
        x = np.column_stack([found[c].to_numpy() for c in "abc"])
        model.coefficients = _logistic(x, y)
    # With the calibration fitted on rows it hadn't counted, the model may count them too.
    every = counts[:2] + counts[2:]
    final = Model(every[0, :-1], every[1, :-1], int(every[0, -1]), int(every[1, -1]))
    final.rate, final.k, final.coefficients = model.rate, model.k, model.coefficients
    return final


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, score (0 to 1), passages (array of start, end, score in words, end exclusive).

    Null and empty texts score as texts without toxic words.  One row per
    input row, in place, no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = f"{id_column} bigint, score double, passages array<struct<start:bigint,end:bigint,score:double>>"
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = sent.value, {}
        for batch in batches:
            both = [model.describe(t, known) for t in batch.column(1).to_pylist()]
            p = model.probability(np.array([x for x, _ in both]).reshape(-1, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array([s for _, s in both], arrow)],
                                             names=[id_column, "score", "passages"])

    return (docs.select(F.col(id_column).cast("bigint").alias(id_column), F.col(text_column).cast("string"))
            .mapInArrow(run, kind))


def keep_clean(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) with a score below ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = sent.value, {}
        for batch in batches:
            x = np.array([model.describe(t, known)[0] for t in batch.column(at).to_pylist()]).reshape(-1, 3)
            yield batch.filter(pa.array(model.probability(x) < threshold))

    return docs.mapInArrow(run, docs.schema)
