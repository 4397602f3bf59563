"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are compared as sequences of lower-case words (``\\w+``).  A document
contains an item of m words if some stretch of it is within
``floor((1 - similarity) * m)`` word edits of the whole item.

Walks drift apart with the number of edits, so an item of more than
``PIECE_WORDS`` words is searched by pieces of about equal length: were each
piece beyond its own allowance, the item would be beyond its own, so some piece
of a match is within ``floor((1 - similarity) * its words)`` edits.  Candidates
of a piece are verified with the whole item.  Items without room for an edit
(under five words at 0.8) are found by exact match.

The corpus is read once per block of items; each task slides item-sized
windows over its documents:

1. Gate without loss: a window of m words that starts where a match starts
   holds at least m - 1 - 2d of the adjacent word pairs of items that long (d:
   allowed edits), because an edit spoils at most two.
2. Windows that pass are embedded by a CGK random walk: at step t the output is
   the current word, and a random bit of (t, word) says whether to move on.
   Edit distance becomes Hamming distance between the walks of window and item.
3. Each repetition has its own walk and samples ``SAMPLES`` of its steps as an
   LSH key.  The number of repetitions follows from the target recall.
4. Windows and items with an equal key in some repetition are verified by the
   exact edit distance of the item to the best stretch at the window.

Items are taken in blocks of bounded size (hash of the item), each block sent
to the tasks; nothing of the documents is shuffled or collected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIMILARITY = 0.8
#: Words above which an item is searched by pieces.
PIECE_WORDS = 60
#: Sampled steps in an LSH key; share of equal steps taken for a pair at the threshold; recall asked for.
SAMPLES = 4
AGREEMENT = 0.55
RECALL = 0.99
#: Words of items in a block, about.
BLOCK_WORDS = 1_000_000
SEED = 20_240_601
#: Documents searched at a time in a task.
ROWS = 8192

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def repetitions(recall: float = RECALL, agreement: float = AGREEMENT, samples: int = SAMPLES) -> int:
    """LSH repetitions so that a pair with that share of equal steps is found with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement ** samples))


def infix_distance(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int]:
    """(distance, end) of the item to the best stretch that starts at any place of ``stretch``; earliest end."""
    row = np.zeros(len(stretch) + 1, dtype=np.int64)
    steps = np.arange(len(stretch) + 1)
    for k, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = k + 1
        new[1:] = np.minimum(row[:-1] + (stretch != w), row[1:] + 1)
        # Insertions: the running minimum of new[j] - j, plus j.
        row = np.minimum.accumulate(new - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


class ItemBlock:
    """A block of items prepared for search; sent to the tasks."""

    def __init__(self, items: list[tuple[int, list[str]]], similarity: float = SIMILARITY,
                 recall: float = RECALL, seed: int = SEED) -> None:
        self.ids, self.similarity = [i for i, _ in items], similarity
        self.codes: dict[str, int] = {}
        self.items = [np.array([self.codes.setdefault(w, len(self.codes)) for w in words]) for _, words in items]
        self.vocabulary = len(self.codes)
        self.allowed = [int((1 - similarity) * len(x) + 1e-9) for x in self.items]
        self.exact = [k for k, d in enumerate(self.allowed) if d == 0]
        # (item, offset of the piece in it, codes of the piece)
        self.parts = [(k, at, x[at:end]) for k, x in enumerate(self.items) if self.allowed[k] > 0
                      for at, end in _pieces(len(x))]
        if not self.parts:
            return
        self.pairs = np.unique(np.concatenate([x[:-1] * self.vocabulary + x[1:] for _, _, x in self.parts]))
        self.lengths = sorted({len(x) for _, _, x in self.parts})
        # Of each length of piece: which pairs its pieces have.
        self.pair_lengths = {m: np.isin(self.pairs, np.concatenate(
            [x[:-1] * self.vocabulary + x[1:] for _, _, x in self.parts if len(x) == m])) for m in self.lengths}
        longest = self.lengths[-1]
        random = np.random.default_rng(seed)
        self.reps = repetitions(recall)
        # A word's random bit at step t of repetition r; code -1 (no word of any item) and -2 (past the end) too.
        self.mix = random.integers(1, 1 << 62, size=(self.reps, 2 * longest, 2), dtype=np.int64) | 1
        # A walk reads a word every other step on average; steps after its end would agree for all items.
        self.steps = {m: np.stack([random.choice(2 * m - m // 4, size=SAMPLES, replace=False)
                                   for _ in range(self.reps)]) for m in self.lengths}
        self.keys: dict[int, list[dict[int, list[int]]]] = {m: [{} for _ in range(self.reps)] for m in self.lengths}
        for m in self.lengths:
            own = [k for k, (_, _, x) in enumerate(self.parts) if len(x) == m]
            flat = np.concatenate([self.parts[k][2] for k in own])
            for table, keys in zip(self.keys[m], self.walk(flat, np.arange(len(own)) * m, m), strict=True):
                for k, key in zip(own, keys.tolist(), strict=True):
                    table.setdefault(key, []).append(k)

    def walk(self, flat: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
        """LSH keys (repetition by window) for the windows of m words at ``starts`` of ``flat``."""
        at = np.zeros((self.reps, len(starts)), dtype=np.int64)
        key = np.zeros_like(at)
        last, steps = len(flat) - 1, self.steps[m]
        for t in range(int(steps.max()) + 1):
            word = np.where(at < m, flat[np.minimum(starts + at, last)], -2) + 3
            sampled = (steps == t).any(axis=1)
            if sampled.any():
                key[sampled] = key[sampled] * 1_000_003 + word[sampled]
            at += (word * self.mix[:, t, :1] + self.mix[:, t, 1:] >> 40) & 1
        return key

    def search(self, flat: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(owner, item, start, end, distance) of the best match of each item in each document.

        ``flat``: word codes of documents one after the other, -1 for words of
        no item; ``ends``: end of each document in it.
        """
        if not len(flat):
            return
        begins = np.concatenate([[0], ends[:-1]])
        yield from self._search_exact(flat, ends, begins)
        if not self.parts:
            return
        both = (flat[:-1] >= 0) & (flat[1:] >= 0)
        code = flat[:-1][both] * self.vocabulary + flat[1:][both]
        spot = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        ends_at = np.flatnonzero(both)[self.pairs[spot] == code] + 1  # place of a pair's second word
        pair = spot[self.pairs[spot] == code]
        inside = ~np.isin(ends_at, ends)  # a pair across two documents is none
        ends_at, pair = ends_at[inside], pair[inside]
        found: dict[tuple[int, int], set[int]] = {}
        for m in self.lengths:
            own = ends_at[self.pair_lengths[m][pair]]
            least = max(m - 1 - 2 * int((1 - self.similarity) * m + 1e-9), 1)
            if len(own) < least:
                continue
            # Runs of ``least`` pairs that fit in a window, and the starts of the windows that hold them.
            first, final = own[: len(own) - least + 1], own[least - 1:]
            close = final - first <= m - 2
            if not close.any():
                continue
            # Both ends rise, so each run adds what lies beyond the end of the one before.
            low, high = np.maximum(final[close] - m + 1, 0), first[close]
            low[1:] = np.maximum(low[1:], high[:-1])
            length = np.maximum(high - low, 0)
            starts = np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())
            if not len(starts):
                continue
            owner = np.searchsorted(ends, starts, side="right")
            for low in range(0, len(starts), 8192):
                part = starts[low:low + 8192]
                for table, keys in zip(self.keys[m], self.walk(flat, part, m), strict=True):
                    for p in np.flatnonzero(np.isin(keys, np.fromiter(table, np.int64, len(table)))):
                        for j in table[int(keys[p])]:
                            k, offset, _ = self.parts[j]
                            found.setdefault((int(owner[low + p]), k), set()).add(int(part[p]) - offset)
        for (o, k), places in found.items():
            m, d = len(self.items[k]), self.allowed[k]
            best = None
            for low, high in _stretches(sorted(places), m, d):
                low, high = max(low, int(begins[o])), min(high, int(ends[o]))
                distance, end = infix_distance(self.items[k], flat[low:high])
                if distance <= d and (best is None or distance < best[0]):
                    back, length = infix_distance(self.items[k][::-1], flat[low:low + end][::-1])
                    assert back == distance
                    best = (distance, low + end - length - int(begins[o]), low + end - int(begins[o]))
            if best:
                yield o, k, best[1], best[2], best[0]

    def _search_exact(self, flat: np.ndarray, ends: np.ndarray,
                      begins: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """First place of each item that allows no edit in each document that has it."""
        for k in self.exact:
            item = self.items[k]
            at = np.flatnonzero(flat[:len(flat) - len(item) + 1] == item[0]) if len(item) <= len(flat) else []
            for j, w in enumerate(item[1:], 1):
                at = at[flat[at + j] == w]
            if not len(at):
                continue
            owner = np.searchsorted(ends, at, side="right")
            whole = at + len(item) <= ends[owner]
            owners, first = np.unique(owner[whole], return_index=True)
            for o, p in zip(owners.tolist(), at[whole][first].tolist(), strict=True):
                start = p - int(begins[o])
                yield o, k, start, start + len(item), 0


def _pieces(m: int) -> Iterator[tuple[int, int]]:
    """(start, end) of as few pieces of m words as have at most PIECE_WORDS, of lengths that differ by one at most."""
    n = -(-m // PIECE_WORDS)
    for k in range(n):
        yield m * k // n, m * (k + 1) // n


def _stretches(places: list[int], m: int, d: int) -> Iterator[tuple[int, int]]:
    """Stretches to verify: around every candidate start, those that overlap joined."""
    low, high = places[0] - d, places[0] + m + d
    for p in places[1:]:
        if p - d <= high:
            high = p + m + d
        else:
            yield low, high
            low, high = p - d, p + m + d
    yield low, high


def item_blocks(items: DataFrame, id_column: str, text_column: str, similarity: float = SIMILARITY,
                block_words: int = BLOCK_WORDS) -> Iterator[ItemBlock]:
    """Blocks of about ``block_words`` words; items without id or without words are left out."""
    rows = items.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("t")).dropna()
    size = rows.agg(F.sum(F.length("t") / 4)).first()[0] or 0
    n = max(1, math.ceil(size / block_words))
    for b in range(n):
        part = rows.filter(F.pmod(F.xxhash64("t"), F.lit(n)) == b).distinct().orderBy("id", "t").collect()
        known = [(r["id"], w) for r in part if (w := words_of(r["t"]))]
        if known:
            yield ItemBlock(known, similarity)


def _searched(batch: pa.RecordBatch, column: int, block: ItemBlock) -> Iterator[tuple[int, int, int, int, int]]:
    """Matches in a slice of documents; rows are positions in the slice."""
    get, codes, ends = block.codes.get, [], []
    for t in batch.column(column).to_pylist():
        codes += [get(w, -1) for w in words_of(t)]
        ends.append(len(codes))
    yield from block.search(np.array(codes, dtype=np.int64), np.array(ends, dtype=np.int64))


def contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item it contains: id, item_id, start_word, end_word, distance, similarity.

    Words are counted from 0, the end is exclusive; the match is the one of
    fewest edits.  Null and empty texts contain nothing.  Several items of one
    id give one row (the best).  Repeated documents give repeated rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("t"))
    kind = f"{id_column} bigint, {item_id} bigint, start_word bigint, end_word bigint, distance bigint, " \
           "similarity double"
    out = None
    for block in item_blocks(items, item_id, item_text, similarity):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                for low in range(0, batch.num_rows, ROWS):
                    part = batch.slice(low, ROWS)
                    best: dict[tuple[int, int], tuple] = {}
                    for o, k, start, end, distance in _searched(part, 1, block):
                        row = (1 - distance / len(block.items[k]), start, end, distance)
                        old = best.get((o, block.ids[k]))
                        if old is None or (-row[0], start, end) < (-old[0], old[1], old[2]):
                            best[o, block.ids[k]] = row
                    cols = [[part.column(0)[o].as_py() for o, _ in best], [i for _, i in best],
                            [x[1] for x in best.values()], [x[2] for x in best.values()],
                            [x[3] for x in best.values()], [x[0] for x in best.values()]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=pa.float64() if i == 5 else pa.int64()) for i, c in enumerate(cols)],
                        names=[id_column, item_id, "start_word", "end_word", "distance", "similarity"])

        found = rows.mapInArrow(run, kind)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], kind)


def decontaminate(docs: DataFrame, items: DataFrame, text_column: str = "text", item_id: str = "item_id",
                  item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns) that contain no item."""
    for block in item_blocks(items, item_id, item_text, similarity):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        at = docs.columns.index(text_column)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, at=at) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, ROWS):
                    part = batch.slice(low, ROWS)
                    bad = {o for o, *_ in _searched(part, at, sent.value)}
                    yield part.filter(pa.array([o not in bad for o in range(part.num_rows)], type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
