"""Best-fit packing of tokenised documents by bin completion.

1. ``token_pieces``: documents are tokenised in Arrow batches and cut into
   pieces of at most ``capacity`` tokens.  White space is dropped by the
   tokenizer, so a text's ids are those of its words in order; a worker encodes
   each distinct word once and joins the ids.
2. Pieces that fill a sequence are sequences by themselves.
3. The others are dealt by their rank in length to groups worth ``group_bins``
   sequences, so that every group has the whole's mix of lengths.  In a group the best-fit decreasing packing is the incumbent; unless it meets the
   lower bound, a branch-and-bound search takes the largest piece left,
   enumerates the undominated fillings around it and prunes a branch whose
   waste can no longer beat the incumbent.
4. The emptiest sequence of every group is opened again; the opened pieces are
   packed in a further round with far fewer groups, until one group is left.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import materialize

CAPACITY = 4096
END_ID = 1
#: Sequences' worth of tokens in a group.
GROUP_BINS = 512
#: Search nodes per group after which the incumbent stands (it is a whole packing at any time).
NODES = 2000
#: Fillings looked at per search node, and pieces added to the largest one in a filling found by search.
FILLINGS = 24
#: Words whose ids a worker remembers.
CACHE_WORDS = 1_000_000

_SEPARATORS = re.compile("[\x1c-\x1f]")
_TAIL = string.punctuation
_ENCODERS: dict[str, tuple] = {}


def _uncached(model: dict):
    from tokenizers.models import BPE

    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    names = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    given = {k: model[k] for k in names if model.get(k) is not None}
    return BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **given)


def _encoder(path: str):
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        tokenizer = Tokenizer.from_file(path)
        # Only words not met before are encoded, so the model's own cache of words would be filled and never hit.
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        tokenizer.model = _uncached(model)
        # Of lower-case ASCII letters the normaliser and the byte level change nothing, and white space parts them.
        letters = Tokenizer(_uncached(model))
        letters.pre_tokenizer = WhitespaceSplit()
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        for piece, i in tokenizer.get_vocab().items():
            ends[i] = piece.endswith("</w>")
        _ENCODERS[path] = (tokenizer, letters, {}, ends, special)
    return _ENCODERS[path]


def text_ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian uint32 bytes."""
    tokenizer, quick, known, ends, special = _encoder(path)
    # str.split also splits at the four information separators, which the tokenizer does not; and special tokens
    # stand wherever they are written.  Such texts are encoded as they are.
    plain = [not _SEPARATORS.search(t) and not any(x in t for x in special) for t in texts]
    # The tokenizer lower-cases; for ASCII that is str.lower, so fewer words differ.
    lists = [(t.lower() if t.isascii() else t).split() if p else [] for t, p in zip(texts, plain, strict=True)]
    found = [list(map(known.get, words)) for words in lists]
    new = {w for words, ids in zip(lists, found, strict=True) if None in ids
           for w, x in zip(words, ids, strict=True) if x is None}
    if len(known) + len(new) > CACHE_WORDS:
        known.clear()
    # Letters and digits never share a token with the marks after them: a word's ids are its stem's and its tail's.
    # (A letter may become letter and combining mark in lower case, which is a mark.)
    cut, alone = [], set()
    for w in new:
        stem = w.rstrip(_TAIL)
        if len(stem) < len(w) and stem and stem[-1].lower()[-1].isalnum():
            cut.append((w, stem, w[len(stem):]))
            alone.add(stem)
            alone.add(cut[-1][2])
        else:
            alone.add(w)
    alone = [w for w in alone if w not in known]
    # A word of letters only is one pre-token, whose last id is an end of word: many such words go as one text.
    letters = [w for w in alone if w.isalpha()]
    ascii_letters = [w for w in letters if w.isascii()]
    other_letters = [w for w in letters if not w.isascii()]
    for words, encoder in ((ascii_letters, quick), (other_letters, tokenizer)):
        for start in range(0, len(words), 4096):
            part = words[start:start + 4096]
            text = " ".join(part).lower() if encoder is quick else " ".join(part)
            ids = np.array(encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(ends[ids]) + 1
            if len(stops) == len(part):
                data, low = ids.tobytes(), 0
                for w, high in zip(part, (4 * stops).tolist(), strict=True):
                    known[w] = data[low:high]
                    low = high
    rest = [w for w in alone if w not in known]
    for start in range(0, len(rest), 4096):
        part = rest[start:start + 4096]
        for w, e in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, dtype="<u4").tobytes()
    for w, stem, tail in cut:
        known[w] = known[stem] + known[tail]
    out = []
    for t, p, words, ids in zip(texts, plain, lists, found, strict=True):
        if not p:
            out.append(np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes())
        elif None in ids:
            out.append(b"".join([known[w] if x is None else x for w, x in zip(words, ids, strict=True)]))
        else:
            out.append(b"".join(ids))
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and ``end_id``, cut at ``capacity``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids, rows = part.column(0).to_pylist(), []
                for i, data in zip(ids, text_ids([t or "" for t in part.column(1).to_pylist()], tokenizer_path),
                                   strict=True):
                    data += end
                    n, step = len(data) // 4, capacity * 4
                    rows += [(i, k, k * capacity, min(capacity, n - k * capacity),
                              zlib.crc32(data[k * step:(k + 1) * step])) for k in range(-(-n // capacity))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return (docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("t"))
            .mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each size goes into the fullest bin with room; sizes come in falling order."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (space left, bin), sorted
    for size in sizes:
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(size)
        if left > size:
            insort(room, (left - size, b))
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Bins that any packing needs: by volume, and with pieces above half and those that fit beside none."""
    total, best = sum(sizes), -(-sum(sizes) // capacity)
    up = sorted(sizes)
    prefix = np.concatenate([[0], np.cumsum(up)])
    for k in sorted({s for s in up if 2 * s <= capacity}):
        large, half, low = bisect_right(up, capacity - k), bisect_right(up, capacity // 2), bisect_left(up, k)
        n_large, n_mid = len(up) - large, large - half
        free = n_mid * capacity - int(prefix[large] - prefix[half])
        rest = int(prefix[half] - prefix[low]) - free
        best = max(best, n_large + n_mid + max(0, -(-rest // capacity)))
    return max(best, sum(2 * s > capacity for s in up)) if total else 0


def fillings(first: int, left: Counter, capacity: int, limit: int) -> list[tuple[int, ...]]:
    """Undominated sets of sizes to add to ``first``, fullest first.

    A set is dominated if some size left out fits in place of one or more of
    its members of at most that size in sum: the larger piece is harder to place.
    """
    sizes = sorted((s for s in left if left[s]), reverse=True)
    found: list[tuple[int, ...]] = []
    steps = 0

    def grow(start: int, room: int, chosen: tuple[int, ...]) -> bool:
        nonlocal steps
        added = False
        for at in range(start, len(sizes)):
            s = sizes[at]
            if s <= room and chosen.count(s) < left[s]:
                added = True
                if grow(at, room - s, (*chosen, s)):
                    return True
                steps += 1
                if steps > 20 * limit:
                    return True
        if not added:
            found.append(chosen)
        return len(found) >= 4 * limit or (found and room == 0 and len(found) >= limit)

    grow(0, capacity - first, ())

    def dominated(chosen: tuple[int, ...]) -> bool:
        room = capacity - first - sum(chosen)
        spare = sizes  # sizes of which a piece is left outside the set
        for low in {chosen[i] + (chosen[j] if i != j else 0) for i in range(len(chosen)) for j in range(i, len(chosen))}:
            top = low + room
            # Falling order: the largest size that still fits in the place made free.
            for s in spare[bisect_left(spare, -top, key=lambda x: -x):]:
                if s < low or (s == low and low in chosen):
                    break
                if left[s] > chosen.count(s):
                    return True
        return False

    kept = [c for c in dict.fromkeys(found) if not dominated(c)] or found[:1]
    return sorted(kept, key=lambda c: (-sum(c), c))[:limit]


def complete_bins(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> list[list[int]]:
    """Bins of sizes (each 1..capacity): bin completion with the best-fit packing as incumbent."""
    sizes = sorted(sizes, reverse=True)
    best = best_fit(sizes, capacity)
    bound = lower_bound(sizes, capacity)
    total, budget = sum(sizes), [nodes]
    if len(best) <= bound:
        return best
    # Depth first: (pieces left before the last filling, that filling, bins so far as a chain, their number, waste so far).
    stack = [(Counter(sizes), (), None, 0, 0)]
    while stack and budget[0] > 0 and len(best) > bound:
        left, filled, chain, n, waste = stack.pop()
        if waste > (len(best) - 1) * capacity - total:
            continue
        budget[0] -= 1
        left = left.copy()
        for s in filled:
            left[s] -= 1
            if not left[s]:
                del left[s]
        if not left:
            if n < len(best):
                best = []
                while chain:
                    best.append(list(chain[0]))
                    chain = chain[1]
            continue
        allowed = (len(best) - 1) * capacity - total
        first = max(left)
        left[first] -= 1
        if not left[first]:
            del left[first]
        for chosen in reversed(fillings(first, left, capacity, FILLINGS)):
            more = waste + capacity - first - sum(chosen)
            if more <= allowed:
                stack.append((left, chosen, ((first, *chosen), chain), n + 1, more))
    return best


def _pack_group(capacity: int, open_last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        bins = complete_bins(rows["length"].tolist(), capacity)
        places: dict[int, list[tuple[int, int]]] = {}
        emptiest = min(range(len(bins)), key=lambda b: sum(bins[b]))
        for b, sizes in enumerate(bins):
            at = 0
            for s in sizes:
                places.setdefault(s, []).append((b, at))
                at += s
        spots = [places[s].pop() for s in rows["length"].tolist()]
        rows["bin"] = [b for b, _ in spots]
        rows["offset"] = [at for _, at in spots]
        rows["open"] = (rows["bin"] == emptiest) if open_last else False
        return rows

    return run


def dealt(pieces: DataFrame, groups: int) -> DataFrame:
    """Adds g: the rank by length modulo ``groups``, so that all groups hold pieces of nearly the same lengths.

    Ranks come from a range partitioning: place in the partition plus the rows
    of the partitions before it.  What is broadcast is one count a partition.
    """
    at = F.monotonically_increasing_id()
    # Rows of one length spread over partitions by their uid.
    placed = materialize(pieces.repartitionByRange("length", "uid").sortWithinPartitions("length", "uid")
                         .withColumn("_part", F.shiftright(at, 33))
                         .withColumn("_place", at.bitwiseAND((1 << 33) - 1)), "placed")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(counts), "_part")
            .withColumn("g", F.pmod(F.col("_before") + F.col("_place"), F.lit(groups)).cast("bigint"))
            .drop("_part", "_place", "_before"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_bins: int = GROUP_BINS) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns doc_id, piece, start, length, ids_crc32)."""
    pieces = materialize(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") == capacity)
    parts = [full.withColumn("sequence_id", F.col("uid") * 2 + 1).withColumn("offset", F.lit(0).cast("bigint"))]
    rest, level = pieces.filter(F.col("length") < capacity), 0
    kind = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in pieces.schema)}, g bigint, " \
           "bin bigint, offset bigint, open boolean"
    while True:
        total = rest.agg(F.sum("length")).first()[0] or 0
        groups = max(1, -(-total // (capacity * group_bins)))
        packed = materialize(
            dealt(rest, groups).groupBy("g")
            .applyInPandas(_pack_group(capacity, groups > 1), kind), "packed")
        number = (F.lit(level).cast("bigint") * (1 << 54) + F.col("g") * (1 << 22) + F.col("bin")) * 2
        parts.append(packed.filter(~F.col("open")).withColumn("sequence_id", number).drop("g", "bin", "open"))
        if groups == 1:
            break
        rest, level = packed.filter("open").select(*pieces.columns), level + 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("uid")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the single token ``end_id``; longer documents are
    cut every ``capacity`` tokens; a null id and repeated rows are packed like
    any other; an empty table gives an empty result.  Other columns are ignored.
    """
    pieces = token_pieces(docs, tokenizer_path, id_column, text_column, capacity, end_id)
    return pack(pieces, capacity).withColumnRenamed("doc_id", id_column)
