"""Token counts by dynamic programming over a trie of distinct pre-tokens.

Documents are cut into pre-tokens (words with a leading word mark).  In every
Arrow chunk the distinct pre-tokens are put into a trie; sorted, they are its
depth-first walk, so a word shares with the one before it all states of their
common prefix.  A state holds the best unigram score of the prefix and the
number of tokens of that segmentation; each trie node is computed once.  The
terminal counts are summed by document.  The vocabulary is a public
tokenizer's; nothing is trained and nothing is shuffled.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Zipf-Mandelbrot offset: a piece of rank r has probability proportional to 1 / (r + OFFSET).
OFFSET = 2.7
#: Added to the rarest piece's score for each UTF-8 byte of a character that no piece covers.
BYTE_PENALTY = -10.0
CHUNK_ROWS = 4096

_VOCABULARIES: dict[str, dict[str, float]] = {}


def vocabulary(path: str) -> dict[str, float]:
    """Piece -> unigram log probability, from a sentencepiece model's pieces in rank order."""
    if path not in _VOCABULARIES:
        import sentencepiece

        if not os.path.isfile(path):
            raise FileNotFoundError(path)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = sum(1 / (r + OFFSET) for r in range(len(pieces)))
        _VOCABULARIES[path] = {p: -math.log((r + OFFSET) * total) for r, p in enumerate(pieces)}
    return _VOCABULARIES[path]


def trie_counts(words: list[str], pieces: dict[str, float]) -> list[tuple[int, float]]:
    """(tokens, score) of each of the sorted distinct words; every trie node is scored once.

    Of equal scores the segmentation of fewer tokens counts.
    """
    longest = max(map(len, pieces), default=1)
    floor = min(pieces.values(), default=0.0) + BYTE_PENALTY
    best, count, before, out = [0.0], [0], "", []
    get = pieces.get
    for word in words:
        shared = 0
        for a, b in zip(word, before, strict=False):
            if a != b:
                break
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            n = len(word[end - 1].encode("utf-8", "replace"))
            top, tokens = best[end - 1] + n * floor, count[end - 1] + n
            for start in range(max(0, end - longest), end):
                piece = get(word[start:end])
                if piece is not None:
                    s = best[start] + piece
                    if s > top or (s == top and count[start] + 1 < tokens):
                        top, tokens = s, count[start] + 1
            best.append(top)
            count.append(tokens)
        out.append((count[len(word)], best[len(word)]))
        before = word
    return out


def token_counts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, n_pretokens, n_tokens, log_prob (natural log of the best segmentation's probability).

    Null and empty texts have no tokens.  One row per input row; other columns
    are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path)
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK_ROWS):
                chunk = batch.slice(low, CHUNK_ROWS)
                texts = pc.fill_null(chunk.column(1), "").cast(pa.large_string())
                for blank in "\t\n\x0b\x0c\r":
                    texts = pc.replace_substring(texts, blank, " ")
                lists = pc.split_pattern(texts, " ")
                flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
                full = pc.not_equal(flat, "")
                flat, owner = flat.filter(full), owner.filter(full).to_numpy()
                found = flat.dictionary_encode()
                order = pc.sort_indices(found.dictionary).to_numpy() if len(found.dictionary) else np.zeros(0, int)
                words = [MARK + w for w in found.dictionary.take(pa.array(order)).to_pylist()]
                scored = np.array(trie_counts(words, pieces)).reshape(-1, 2)
                terminal = np.empty_like(scored)
                terminal[order] = scored
                each, n = terminal[found.indices.to_numpy()], chunk.num_rows
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                     pa.array(np.bincount(owner, weights=each[:, 0], minlength=n).astype(np.int64)),
                     pa.array(np.bincount(owner, weights=each[:, 1], minlength=n))],
                    names=[id_column, "n_pretokens", "n_tokens", "log_prob"])

    return (docs.select(F.col(id_column).cast("bigint").alias(id_column), F.col(text_column).cast("string"))
            .mapInArrow(run, f"{id_column} bigint, n_pretokens bigint, n_tokens bigint, log_prob double"))
