"""Recall of decontamination on long items at the threshold, and exact search of short ones."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_packing_and_decontamination import brute_contains

from ontime.llm import cgk_decontam as C


def searched(items, texts):
    block = C.ItemBlock(list(enumerate(items)))
    flat = [block.codes.get(w, -1) for words in texts for w in words]
    ends = np.cumsum([len(words) for words in texts])
    return list(block.search(np.array(flat, dtype=np.int64), ends))


@pytest.mark.parametrize("words", [60, 61, 100, 150, 250, 300])
def test_recall_at_a_fifth_of_the_words(words):
    """One copy of each of 30 items with as many random edits as the threshold allows."""
    rng = random.Random(words)
    pool = [f"w{i}" for i in range(800)] + ["the", "of", "and", "to"] * 60
    items = [[rng.choice(pool) for _ in range(words)] for _ in range(30)]
    texts = []
    for item in items:
        copy = list(item)
        for _ in range(words // 5):
            at, what = rng.randrange(len(copy)), rng.randrange(3)
            copy[at:at + (what != 1)] = [] if what == 0 else [rng.choice(pool)]
        texts.append([rng.choice(pool) for _ in range(40)] + copy + [rng.choice(pool) for _ in range(40)])
    got = {(o, k): d for o, k, _, _, d in searched(items, texts)}
    assert sum((k, k) in got for k in range(30)) >= 27
    for (o, k), d in got.items():
        assert d == brute_contains(items[k], texts[o]) <= words // 5


def test_short_items_are_found_by_exact_match():
    rng = random.Random(5)
    items = [["alpha"], ["alpha", "beta"], ["beta", "alpha", "beta"], ["a", "b", "a", "b"], ["not", "there"]]
    texts = [[rng.choice(["alpha", "beta", "a", "b", "x"]) for _ in range(rng.randrange(0, 25))] for _ in range(200)]
    got = sorted(searched(items, texts))
    want = []
    for o, text in enumerate(texts):
        for k, item in enumerate(items):
            at = [i for i in range(len(text) - len(item) + 1) if text[i:i + len(item)] == item]
            if at:
                want.append((o, k, at[0], at[0] + len(item), 0))
    assert got == sorted(want) and {k for _, k, *_ in got} == {0, 1, 2, 3}


def test_pieces_cover_an_item_and_share_its_allowance():
    for m in range(1, 700):
        parts = list(C._pieces(m))
        assert parts[0][0] == 0 and parts[-1][1] == m and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        sizes = [end - at for at, end in parts]
        assert max(sizes) <= C.PIECE_WORDS and max(sizes) - min(sizes) <= 1
        # One edit more than its allowance in every piece is more than the item's.
        assert sum(int(0.2 * n + 1e-9) + 1 for n in sizes) > int(0.2 * m + 1e-9)
