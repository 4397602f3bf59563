"""Toxicity and language-model scoring."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import AWKWARD_ROWS
from pyspark.sql import functions as F

from ontime.llm import suffix_tree_lm as L
from ontime.llm import toxic_segments as T
from ontime.llm.common import read


def brute_maximal(scores):
    """All maximal scoring segments by the recursive definition: the best, then left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-12 or (abs(total - best[2]) <= 1e-12 and j + 1 - i < best[1] - best[0])):
                best = (i, j + 1, total)
    if best is None:
        return []
    left, right = brute_maximal(scores[:best[0]]), brute_maximal(scores[best[1]:])
    return left + [best] + [(a + best[1], b + best[1], s) for a, b, s in right]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([-3.37, -2.11, -1.03, 0.71, 1.59, 2.83]), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    scores = [s + 0.001 * math.sin(i) for i, s in enumerate(scores)]  # no ties
    got = T.maximal_segments(np.array(scores))
    want = sorted(brute_maximal(scores))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_held_out_accuracy(spark):
    """Labels of one fold only; the other fold's toxic documents are found and its clean ones left alone."""
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = T.fit(docs, labels, training=fold != 1)
    held = T.score(docs, model).join(labels.filter((fold == 1) & F.col("toxic").isNotNull()), "doc_id")
    hit = (F.col("score") >= T.THRESHOLD).cast("int")
    r = held.agg(F.avg(F.when(F.col("toxic") == 1, hit)).alias("recall"),
                 F.avg(F.when(F.col("toxic") == 0, hit)).alias("alarms")).first()
    assert r["recall"] > 0.9 and r["alarms"] < 0.02


def toxic_docs(make_docs, n=400):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioudfgklmnprst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        if i % 4 == 0:
            for w in rng.sample(["vilething", "grossword", "badcall"], 2):
                text.insert(rng.randrange(len(text)), w)
        rows.append((i, " ".join(text)))
    return make_docs(rows)


def test_passages_and_inflected_forms(spark, make_docs):
    docs = toxic_docs(make_docs)
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    model = T.fit(docs, labels)
    probe = make_docs([(1, "ka le mi vilething grossword no pu"), (2, "ka le mi no pu"), (3, "ka VILETHINGS! mi"),
                       (4, None), (5, "")])
    got = {r["doc_id"]: r for r in T.score(probe, model).collect()}
    assert got[1]["score"] >= 0.7 > 0.3 > got[2]["score"]
    assert (got[1]["passages"][0]["start"], got[1]["passages"][0]["end"]) == (3, 5) and not got[2]["passages"]
    assert got[3]["score"] > got[2]["score"]  # the stem speaks for the form
    assert abs(got[4]["score"] - got[5]["score"]) < 1e-12 and 0 <= got[4]["score"] < 0.5
    assert {r["doc_id"] for r in T.keep_clean(probe, model).collect()} >= {2, 4, 5}
    assert 1 not in {r["doc_id"] for r in T.keep_clean(probe, model).collect()}


def test_toxicity_without_labels_or_rows(spark, awkward, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(None, 1), (4, None), (4, 0), (4, 0), (6, 0)], "doc_id bigint, toxic int")
    for labels in (none, odd):
        model = T.fit(awkward, labels)
        rows = T.score(awkward, model).collect()
        assert len(rows) == len(AWKWARD_ROWS) and all(0 <= r["score"] < 0.5 for r in rows)
        assert T.keep_clean(awkward, model).count() == len(AWKWARD_ROWS)
    assert T.score(make_docs([]), T.fit(make_docs([]), none)).count() == 0


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [L.END]


def brute_base(rows, training):
    counts = Counter(t for i, text in rows if training(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        t = tokens_of(text)
        out.append((i, len(t), sum(w in counts for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)))
    return sorted(out, key=repr)


def same_base(got, want):
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 7 != 2


def in_training(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 != 2


def test_base_score_equals_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = L.score(docs, fold()).collect()
    same_base(rows, brute_base([(r["doc_id"], r["text"]) for r in docs.collect()], in_training))


def test_rare_words_meet_their_counts(spark, monkeypatch):
    """With a high least share nearly all words go through the shuffle join; the result stays."""
    monkeypatch.setattr(L, "HEAD", 0.01)
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = L.score(docs, fold()).collect()
    same_base(rows, brute_base([(r["doc_id"], r["text"]) for r in docs.collect()], in_training))


def test_lm_awkward_rows(awkward, make_docs):
    rows = L.score(awkward, fold()).collect()
    same_base(rows, brute_base(AWKWARD_ROWS, in_training))
    assert all(math.isfinite(r["score"]) for r in rows)
    alone = L.score(awkward, F.lit(False)).collect()
    assert {r["train_tokens"] for r in alone} == {0} and all(r["n_known"] == 0 for r in alone)
    assert L.score(make_docs([]), fold()).count() == 0


def chain_docs(make_docs, n=300, seed=1):
    """Texts of a chain whose next word depends on the two before it."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = ["a", "b"]
        for _ in range(60):
            w.append({"ab": "c", "bc": "a", "ca": "b"}.get(w[-2] + w[-1], "a") if rng.random() < 0.9 else rng.choice("abcd"))
        rows.append((i, " ".join(w)))
    return make_docs(rows)


def test_tree_learns_contexts_and_scores_held_out_texts_better(make_docs):
    docs = chain_docs(make_docs)
    held = [r for r in L.score(docs, fold()).collect() if not in_training(r["doc_id"])]
    assert sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)


def test_state_distributions_sum_to_one(make_docs):
    docs = chain_docs(make_docs)
    rows = L._rows(docs, "doc_id", "text", F.lit(True))
    counts = L.materialize(L.word_counts(rows), "words")
    tree = L.fit(rows, counts)
    assert len(tree.levels[0][0]) and len(tree.levels[1][0])
    base = 10 ** tree.root(tree.counts.astype(float))
    unseen = 1 / (tree.total + tree.distinct + 1)
    assert base.sum() + unseen == pytest.approx(1)
    for before in [(x,) for x in range(tree.symbols)] + [(x, y) for x in range(tree.symbols) for y in range(tree.symbols)]:
        if before[0] == tree.end and len(before) > 1 or tree.end in before[1:]:
            continue
        total = 0.0
        for w in [*range(tree.symbols), -1]:
            flat = np.array([tree.end, *before, w])
            text = np.array([-1] + [0] * (len(before) + 1))
            total += (base[w] if w >= 0 else unseen) * 10 ** tree.gain(flat, text)[-1]
        assert total == pytest.approx(1, abs=1e-9)


def test_rows_of_one_large_batch_all_count(make_docs):
    """A task's batch of more than ``CHUNK_ROWS`` rows is cut; the later cuts' words count like the first's."""
    rows = [(i, f"Word{i % 50} AND w{i} ÄB") for i in range(L.CHUNK_ROWS + 500)]
    same_base(L.score(make_docs(rows, parts=1), fold()).collect(), brute_base(rows, in_training))


def brute_score(rows, training):
    """The tree by its definition, with dictionaries: any number of words a context, absolute counts."""
    texts = [tokens_of(t) for i, t in rows if training(i)]
    counts = Counter(w for t in texts for w in t)
    unseen = sum(counts.values()) + len(counts) + 1
    runs = Counter()
    for t in texts:
        t = [L.END, *t]
        runs.update(tuple(t[i - d:i + 1]) for i in range(1, len(t)) for d in range(1, i + 1))
    after = {}
    for r, n in runs.items():
        after.setdefault(r[:-1], {})[r[-1]] = n
    states = {}

    def p(w, context):
        if not context:
            return (counts[w] + 1) / unseen
        if context not in states:
            return p(w, context[1:])
        total, listed, backoff = states[context]
        q = p(w, context[1:])
        return (listed[w] + L.MU * q) / (total + L.MU) if w in listed else backoff * q

    for context in sorted(after, key=len):
        total, listed = sum(after[context].values()), {w: n for w, n in after[context].items() if n >= L.LEAST}
        if not listed or len(context) > 1 and context[1:] not in states:
            continue
        q = {w: p(w, context[1:]) for w in listed}
        rest, free = total - sum(listed.values()), max(1 - sum(q.values()), 1e-12)
        kl = sum(n / total * math.log(n / total / q[w]) for w, n in listed.items())
        kl += rest / total * math.log(rest / total / free) if rest else 0
        if 2 * total * kl >= max(len(listed) + L.DEVIATIONS * math.sqrt(2 * len(listed)), L.LEAST_GAIN):
            states[context] = total, listed, (rest + L.MU * free) / ((total + L.MU) * free)
    out = []
    for i, text in rows:
        t, total = [L.END, *tokens_of(text)], 0.0
        for at in range(1, len(t)):
            kept = [d for d in range(1, at + 1) if tuple(t[at - d:at]) in states]
            total += math.log10(p(t[at], tuple(t[at - max(kept, default=0):at])))
        out.append((i, total))
    return sorted(out, key=repr), states


@pytest.mark.parametrize("shares", [None, (0.02, 0.02), (1.0, 1.0)])
def test_score_equals_brute_force(make_docs, monkeypatch, shares):
    """Contexts of any length, with all, some or no words and runs sent to the tasks."""
    if shares:
        monkeypatch.setattr(L, "HEAD", shares[0])
        monkeypatch.setattr(L, "LISTED", shares[1])
    rng = random.Random(5)
    rows = []
    for i in range(260):
        w = ["a", "b", "c"]
        for _ in range(rng.randrange(50)):  # the next word depends on the three before it
            w.append("abcd"[zlib.crc32(" ".join(w[-3:]).encode()) % 4] if rng.random() < 0.8 else rng.choice(["a", "b", "Once", f"w{rng.randrange(40)}"]))
        rows.append((i, rng.choice([" ", "\n"]).join(w)))
    rows += [(900, None), (901, ""), (None, "a b c"), (902, "a"), (902, "a")]
    want, states = brute_score(rows, in_training)
    assert max(map(len, states)) > 2
    got = sorted(((r["doc_id"], r["score"]) for r in L.score(make_docs(rows), fold()).collect()), key=repr)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-9)


def test_rare_words_are_contexts_at_any_corpus_size(make_docs):
    """A passage that occurs twice is learnt however many other words there are."""
    passage = " ".join(f"seldom{k}" for k in range(30))
    rng = random.Random(3)
    other = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(400))) for i in range(250)]
    docs = make_docs([(1000, passage), (1001, passage), (1002, " ".join(reversed(passage.split()))), *other])
    got = {r["doc_id"]: r["score"] - r["base_score"] for r in L.score(docs, F.col("doc_id") != 1002).collect()}
    assert got[1000] == pytest.approx(got[1001]) and got[1000] > 50 > 5 > got[1002]
