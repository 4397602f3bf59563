"""Exact dedup and SimHash near-dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from llm_rows import AWKWARD_ROWS

from ontime.llm.common import read
from ontime.llm.components import connected_components
from ontime.llm.exact_runs import digest_classes, exact_dedup
from ontime.llm.simhash_trie import fingerprint_links, keep_one, near_duplicates, spanning_links, trie_pairs

SF_SMALL = "/root/testdata/sf0.001"


def brute_exact(rows, pick):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: pick([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""],
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)


@pytest.mark.parametrize("largest", [True, False])
def test_exact_dedup_awkward_rows(awkward, largest):
    got = sorted((tuple(r) for r in exact_dedup(awkward, keep_largest=largest).collect()), key=repr)
    assert got == brute_exact(AWKWARD_ROWS, max if largest else min)


def test_exact_dedup_small_table_and_merge_rounds(spark):
    docs = read(spark, SF_SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in exact_dedup(docs.repartition(20), keep_largest=True).collect()), key=repr)
    assert got == brute_exact(rows, max)


def test_digests_that_disagree_in_the_check_stay_apart(spark):
    rows = [("ab" * 32, 1, 5, 7, 1), ("ab" * 32, 2, 5, 9, 1), ("ab" * 32, 1, 5, 3, 1)]
    df = spark.createDataFrame(rows, "digest string, check bigint, size bigint, keep_id bigint, n bigint").repartition(3)
    got = sorted((r["check"], r["keep_id"], r["n"]) for r in digest_classes(df).collect())
    assert got == [(1, 3, 2), (2, 9, 1)]


def test_exact_dedup_empty_table(make_docs):
    out = exact_dedup(make_docs([]))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)].append(doc)
    return sorted(((doc, f"{fps[i]:016x}", min(ids[find(i)], default=None)) for i, (doc, _) in enumerate(rows)), key=repr)


def test_near_duplicates_awkward_rows(awkward):
    got = sorted((tuple(r) for r in near_duplicates(awkward).collect()), key=repr)
    assert got == brute_components(AWKWARD_ROWS)


def test_near_duplicates_small_table(spark):
    docs = read(spark, SF_SMALL, "documents")
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr)
    assert got == brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_duplicates_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def clustered(n, seed=3):
    """Fingerprints around a few centres, so one top block is crowded."""
    rng = random.Random(seed)
    out = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        out |= {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1) for _ in range(n // 4)}
    return sorted(out)


def test_trie_pairs_equals_all_pairs():
    values = np.array(clustered(600), dtype=np.uint64)
    got = sorted((int(a), int(b)) for i, j in trie_pairs(values, np.array([[0, len(values)] * 2])) for a, b in zip(i, j))
    want = [(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
            if (int(values[i]) ^ int(values[j])).bit_count() <= 3]
    assert got == want


def test_spanning_links_joins_chains():
    root = spanning_links(6, iter([(np.array([0, 2]), np.array([1, 3])), (np.array([1]), np.array([2]))]))
    assert root.tolist() == [0, 0, 0, 0, 4, 5]


def test_hot_top_node_is_split_without_losing_links(spark):
    values = clustered(800, seed=9)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = fingerprint_links(fps, split_rows=50)
    got = {r["node"]: r["component"] for r in connected_components(links, "src", "dst").collect()}
    root = {v: v for v in signed}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 3:
                x, y = find(signed[i]), find(signed[j])
                root[max(x, y)] = min(x, y)
    assert {v: got.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_components_of_chain_star_and_nulls(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3), (300, 300)]
    out = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    got = {r["node"]: r["component"] for r in out.collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, **{200 + i: 100 for i in range(50)}}
    assert out.count() == len(got)


def test_keep_one_of_each_group(make_docs):
    text = " ".join(f"word{i}" for i in range(200))
    docs = make_docs([(5, text), (3, text), (9, text + " more"), (3, text), (20, "something else entirely here"), (None, "no id")])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) in ([20, 3, None], [20, 3, 9, None])
