"""Packing round trips and decontamination against brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import AWKWARD_ROWS
from tokenizers import Tokenizer

from ontime.llm import bin_completion as B
from ontime.llm import cgk_decontam as C
from ontime.llm.common import read

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(sizes=st.lists(st.integers(1, 60), max_size=9))
def test_bin_completion_is_optimal_on_small_sets(sizes):
    bins = B.complete_bins(sizes, 60)
    assert sorted(s for b in bins for s in b) == sorted(sizes) and all(sum(b) <= 60 for b in bins)

    def fits(left, room):
        if not left:
            return True
        return any(fits(left[1:], room[:i] + [r - left[0]] + room[i + 1:])
                   for i, r in enumerate(room) if r >= left[0] and r not in room[:i])

    fewest = next(n for n in range(len(sizes) + 1) if fits(sorted(sizes, reverse=True), [60] * n))
    assert len(bins) == fewest >= B.lower_bound(sizes, 60)


def test_search_beats_best_fit():
    sizes = [6, 5, 5, 4, 4, 3, 3]  # best fit needs 4 bins of 10 where 3 do
    random.seed(5)
    better = 0
    for _ in range(300):
        sizes = [random.randint(10, 50) for _ in range(14)]
        got, plain = len(B.complete_bins(sizes, 100)), len(B.best_fit(sorted(sizes, reverse=True), 100))
        assert got <= plain
        better += got < plain
    assert better


# Letters that change under lower case, marks beside them, special tokens, odd separators.
ODD_PARTS = st.sampled_from(["İ.", "İ!", "ſ?", "K.", "ǰ.", "ß.", "ABC!!", "a<|endoftext|>b", "<|startoftext|>", "don't", "\x1c", "é.",
                             "½.", "ﬁ.", "ŉ.", "東京.", "😀.", "a_.", "3.5", " ", "\n"])


@given(texts=st.lists(st.one_of(st.text(max_size=40), st.lists(ODD_PARTS, max_size=8).map("".join)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_word_cache_gives_the_tokenizers_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in B.text_ids(texts, PATH)] == want


def test_words_share_the_ids_of_their_stem_and_marks():
    B._ENCODERS.pop(PATH, None)
    texts = ["menteraar*** Menteraar### été$$$ dogs' it's\x01** x\x7f!! <b>&&& don't.' ÉTÉ%% " + w for w in ("Abc", "É", "***")]
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in B.text_ids(texts, PATH)] == want
    known = next(x for x in B._ENCODERS[PATH] if isinstance(x, dict))
    assert {"menteraar", "***", "###", "été", "$$$"} <= set(known)


def check_packing(rows, docs):
    """Every document's ids are there once, in order, and sequences are gapless and within bounds."""
    tokenizer = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k:k + 4096], dtype="<u4")
            want[i, k // 4096, k, len(part), zlib.crc32(part.tobytes())] += 1
    got, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins), -(-sum(r["length"] for r in rows) // 4096)


def test_packing_awkward_rows(awkward):
    n, least = check_packing(B.pack_documents(awkward, PATH).collect(), AWKWARD_ROWS)
    assert n == least


def test_packing_small_table_in_several_rounds(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    n, least = check_packing(B.pack_documents(docs, PATH).collect(), pairs)
    assert n == least
    many = B.pack(B.token_pieces(docs, PATH), group_bins=4)  # many groups, so sequences are opened again
    n, least = check_packing(many.collect(), pairs)
    assert n <= 1.1 * least + 1


def test_packing_empty_table(make_docs):
    assert B.pack_documents(make_docs([]), PATH).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_contains(item, words):
    """Fewest edits of the item to any stretch of the words."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def planted(seed=11, n_items=12, n_docs=80):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)] + ["the", "of", "and", "to"] * 40
    text = lambda n: [rng.choice(pool) for _ in range(n)]
    items = [(k, text(rng.randrange(8, 45))) for k in range(n_items)]
    docs = []
    for d in range(n_docs):
        words = text(rng.randrange(5, 150))
        if d % 2:
            k, item = rng.choice(items)
            copy = list(item)
            for _ in range(rng.randrange(int(0.3 * len(item)) + 1)):
                at, what = rng.randrange(len(copy)), rng.randrange(3)
                copy[at:at + (what != 1)] = [] if what == 0 else [rng.choice(pool)]
            at = rng.randrange(len(words) + 1)
            words = words[:at] + copy + words[at:]
        docs.append((d, words))
    return items, docs


def test_decontamination_finds_what_brute_force_finds(spark, make_docs):
    items, docs = planted()
    want = {(d, k) for d, words in docs for k, item in items
            if brute_contains(item, words) <= int(0.2 * len(item) + 1e-9)}
    table = spark.createDataFrame([(k, " ".join(w).upper() + ".") for k, w in items], "item_id bigint, text string")
    docs = make_docs([(d, ", ".join(w)) for d, w in docs])
    rows = C.contaminated(docs, table).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 15
    for r in rows:
        assert r["similarity"] >= 0.8 - 1e-9 and r["end_word"] > r["start_word"]
    kept = {r["doc_id"] for r in C.decontaminate(docs, table).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in got}


def test_blocks_of_items_give_the_same_rows(spark, make_docs):
    items, docs = planted(seed=3)
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id bigint, text string")
    docs = make_docs([(d, " ".join(w)) for d, w in docs])
    assert len(list(C.item_blocks(table, "item_id", "text", block_words=100))) > 1
    assert C.repetitions(0.99, 0.55, 4) == 48


def test_infix_distance_equals_plain_distance():
    rng = random.Random(1)
    for _ in range(100):
        a = np.array([rng.randrange(4) for _ in range(rng.randrange(1, 8))])
        b = np.array([rng.randrange(4) for _ in range(rng.randrange(0, 12))], dtype=np.int64)
        got, end = C.infix_distance(a, b)
        best = min(distance(a.tolist(), b[i:j].tolist()) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert got == best and min(distance(a.tolist(), b[i:end].tolist()) for i in range(end + 1)) == best


def test_decontamination_awkward_rows(spark, awkward, make_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (None, "an item without an id is none"),
                                   (4, "a text without an id is a text"), (4, "a text without an id is a text")],
                                  "item_id bigint, text string")
    rows = C.contaminated(awkward, items).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in rows] == [(None, 4, 0)]
    assert C.decontaminate(awkward, items).count() == awkward.count() - 1
    assert C.contaminated(make_docs([]), items).count() == 0
    assert C.contaminated(awkward, items.limit(0)).count() == 0
    assert C.decontaminate(awkward, items.limit(0)).count() == awkward.count()


@pytest.mark.parametrize("copies", [1, 3])
def test_repeated_documents_repeat_their_rows(spark, make_docs, copies):
    text = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(7, text)], "item_id bigint, text string")
    docs = make_docs([(1, "start " + text + " end")] * copies)
    assert [r["start_word"] for r in C.contaminated(docs, items).collect()] == [1] * copies
