"""Conversation repair, fill-in-middle and robust quality rules against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import AWKWARD_ROWS
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from ontime.llm import fill_middle as M
from ontime.llm import queries
from ontime.llm import robust_outliers as Q
from ontime.llm import turn_repair as R
from ontime.llm.common import read

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- conversation repair


def brute_repair(letters):
    """(cost, audit) of the best of all edit strings, by trying every one that is not dearer than deleting all."""
    limit = 3 * len(letters)
    best = [(limit, "D" * len(letters))]

    def legal(roles):
        return re.fullmatch("(s?(ua)+)?", roles)

    def go(i, roles, cost, audit):
        if cost > best[0][0]:
            return
        if i == len(letters):
            if legal(roles):
                best[0] = min(best[0], (cost, audit))
            if not roles or len(roles) < 2 * len(letters) + 3:
                for r in "ua":
                    if legal_start(roles + r):
                        go(i, roles + r, cost + 2, audit + "I")
            return
        c = letters[i]
        go(i + 1, roles, cost + 3, audit + "D")
        if c != "d":
            extra = int(c.isupper())
            for r, price, e in [(c.lower(), 0, "K"), ("u", 2, "R"), ("a", 2, "R")]:
                if legal_start(roles + r):
                    go(i + 1, roles + r, cost + price + extra, audit + e)
        for r in "ua":
            if legal_start(roles + r):
                go(i, roles + r, cost + 2, audit + "I")

    def legal_start(roles):
        return re.fullmatch("s?(ua)*u?", roles)

    go(0, "", 0, "")
    return best[0]


def by_chunks(letters, size):
    parts = [letters[i:i + size] for i in range(0, len(letters), size)]
    found = ((k, [{"start": s, "end": e, "cost": c, "edits": x} for s in (range(4) if k else (0,))
                  for e, c, x in R.search(p, s)]) for k, p in enumerate(parts))
    out = R.chain(found)
    return sum(c for _, c, _ in out), "".join(e for *_, e in out).translate(str.maketrans("JS", "IR"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="suaxSUAXd", min_size=1, max_size=6))
def test_search_finds_the_best_of_all_repairs(letters):
    want = brute_repair(letters)
    assert [by_chunks(letters, size) for size in (1, 2, 3, 64)] == [want] * 4


def test_search_stays_small_on_long_pieces():
    rng = random.Random(3)
    for pool in ("ua", "suaxSUAXd", "uaUAd", "xd", "sX"):
        letters = "".join(rng.choice(pool) for _ in range(R.CHUNK * 8))
        assert by_chunks(letters, R.CHUNK) == by_chunks(letters, R.CHUNK // 4)


TURNS = "conv_id bigint, turn bigint, role string, text string, pos int, letter string"


def awkward_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, None, "system", "Be nice."),
            (2, 5, None, None), (2, 9, "tool", "x"), (3, 0, "user", ""), (3, 1, "user", " \t\r\n\x0b\x0c "), (None, 3, "user", "A?"),
            (None, 3, "user", "B!"), (None, None, "", "ends in a nbsp. "), (4, 0, "user", "word " * 20000 + "end."),
            (4, 7, "assistant", "no stop"), (4, 7, "assistant", "no stop")]
    rows += [(5, t, ("user", "assistant", "user")[t % 3], f"row {t}.") for t in range(300)]
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], TURNS).repartition(3)


def test_repair_matches_sql_on_awkward_turns(spark, tmp_path):
    df = awkward_turns(spark)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duck(SF)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    ok, msg = compare(queries.QUERIES["op11_turn_repair"](spark, str(tmp_path)), con, queries.SQL["op11_turn_repair"])
    assert ok, msg


def test_repaired_turns_are_legal(spark):
    report, turns = R.repair(awkward_turns(spark))
    rows = turns.orderBy("conv_id", "pos", "k").collect()
    for key in {r["conv_id"] for r in rows}:
        initials = "".join(r["role"][:1] for r in rows if r["conv_id"] == key)
        assert re.fullmatch("(s?(ua)+)?", initials), (key, initials)
    assert all(r["text"] == "" for r in rows if r["edit"] == "insert")
    facts = {r["conv_id"]: r for r in report.collect()}
    assert facts[1]["audit"] == "KKKD" and facts[1]["cost"] == 3 and facts[1]["duplicate"] == 1
    assert facts[3]["blank"] == 2 and facts[3]["audit"] == "DD" and facts[4]["gaps"] == 6


def test_repair_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.QUERIES["op11_turn_repair"](spark, str(tmp_path)).count() == 0


def test_repair_query_matches_sql(spark):
    ok, msg = compare(queries.QUERIES["op11_turn_repair"](spark, SF), duck(SF), queries.SQL["op11_turn_repair"])
    assert ok, msg


# ---------------------------------------------------------------- fill in the middle


def brute_fim(text, doc_id):
    units, at = [], 0
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end + 1
        units.append(text[at:end])
        at = end
    d = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_ROWS = [(i, t) for i, t in AWKWARD_ROWS] + [
    (20, "\n"), (21, "\n\n\n"), (22, "no end"), (23, "a\r\nb\rc\n"), (24, "has a <M> mark"), (25, "<P"), (26, "ends in <\n<S\nP>"),
    (27, "\x0b\x0c \u0085 odd line ends\nx"), (28, "line\n" * 50_000), (29, "😀\n😀😀")]


def test_fill_in_middle_against_brute_force(make_docs):
    docs = make_docs(FIM_ROWS).withColumn("output", F.lit("clash")).withColumn("n", F.lit(1))
    out = M.fill_in_middle(docs)
    found = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                       M.restore("output", "form").alias("back")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    want = [(i, *brute_fim(t or "", "" if i is None else i), t or "") for i, t in FIM_ROWS]
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n<PSM>é", max_size=30), st.integers(0, 10**6))
def test_cut_is_the_brute_force_cut(text, doc_id):
    assert M.cut(text, str(doc_id), M.regex.compile(f"({M.LINE})*")) == brute_fim(text, doc_id)


def test_invalid_bytes_come_back(spark):
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.expr("cast(X'61FF0A62C30A' as string)").alias("text"))
    out = M.fill_in_middle(df)
    assert {r[0] for r in out.select(F.hex(M.restore("output", "form").cast("binary"))).collect()} == {"61FF0A62C30A"}


def test_rates(make_docs):
    docs = make_docs([(i, f"one\ntwo {i}\nthree") for i in range(400)])
    forms = Counter(r["form"] for r in M.fill_in_middle(docs, rate=50, spm_rate=25).collect())
    assert 150 < forms["plain"] < 250 and 0.15 < forms["spm"] / (forms["spm"] + forms["psm"]) < 0.35


def test_fill_query_matches_sql(spark):
    ok, msg = compare(queries.QUERIES["op12_fill_middle"](spark, SF), duck(SF), queries.SQL["op12_fill_middle"])
    assert ok, msg


# ---------------------------------------------------------------- robust quality rules


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


QUALITY_ROWS = AWKWARD_ROWS + [(30, "a b c " * 20), (31, "# * $ %% & | <> x\nsame\nsame\n same"), (32, "w " * 49), (33, "a b c d a b c"),
                               (34, "\n".join(f"line {i} of text" for i in range(40))), (35, "   x y")]


def test_counts_against_brute_force(make_docs):
    docs = make_docs(QUALITY_ROWS).withColumn("n_words", F.lit("clash"))
    found = Q.quality(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = []
    for i, t in QUALITY_ROWS:
        c = brute_counts(t or "")
        want.append((i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert sorted([tuple(r)[:7] for r in found], key=key) == sorted(want, key=key)
    assert all(r["kept"] != r["base_failed"] for r in found)  # too few rows for an estimate


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n#<é\x0b", max_size=40))
def test_counts_of_any_text(text):
    assert Q.counts(text.encode())[:5] == brute_counts(text)


def sample(rng, n):
    pool = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    return ["\n".join(" ".join(rng.choice(pool) for _ in range(rng.randrange(5, 15))) for _ in range(rng.randrange(6, 40)))
            for _ in range(n)]


@pytest.fixture(scope="module")
def mixed(make_docs):
    rng = random.Random(4)
    texts = sample(rng, 900)
    bad = {i: kind for i, kind in zip(range(0, 300, 2), ["bar", "sym", "caps"] * 50, strict=True)}
    made = []
    for i, t in enumerate(texts):
        kind = bad.get(i)
        t = {"bar": lambda t: t.replace(" ", " | "), "sym": lambda t: t.replace(" ", "### "), "caps": str.upper}.get(kind, str)(t)
        made.append((i, t, "hot" if i < 600 else f"s{i % 7}", "en"))
    return made, bad


def brute_models(rows):
    """Concentration steps of one group in numpy with the exact subset, from the three starts."""
    x = rows
    m = np.median(x, axis=0)
    s = np.maximum(np.median(np.abs(x - m), axis=0) * 1.4826, list(Q.FLOORS.values()))
    z, floor = (x - m) / s, np.diag((np.array(list(Q.FLOORS.values())) / s) ** 2)
    t, sign = np.tanh(z), z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    best = None
    for cov in (np.eye(Q.P), t.T @ t / len(z), sign.T @ sign / len(z)):
        c, cov = np.zeros(Q.P), cov + floor
        for _ in range(Q.STEPS):
            d = np.einsum("ij,jk,ik->i", z - c, np.linalg.inv(cov), z - c)
            inside = z[np.argsort(d, kind="stable")[:math.ceil(Q.SHARE * len(z))]]
            c = inside.mean(axis=0)
            cov = (inside - c).T @ (inside - c) / len(inside) * Q.consistency(Q.SHARE) + floor
        best = min(best, (np.linalg.slogdet(cov)[1], c, cov), key=lambda b: b[0]) if best else (np.linalg.slogdet(cov)[1], c, cov)
    _, c, cov = best
    d = np.einsum("ij,jk,ik->i", z - c, np.linalg.inv(cov), z - c)
    inside = z[d <= Q.chi2_quantile(Q.WEIGHED)]
    c = inside.mean(axis=0)
    cov = (inside - c).T @ (inside - c) / len(inside) * Q.consistency(Q.WEIGHED) + floor
    return np.einsum("ij,jk,ik->i", z - c, np.linalg.inv(cov), z - c)


def test_outliers_against_exact_subsets(make_docs, mixed):
    made, bad = mixed
    found = {r["doc_id"]: r for r in Q.quality(make_docs(made)).collect()}
    assert {i for i, r in found.items() if not r["kept"] and not r["base_failed"]} == set(bad)
    for hot in (True, False):
        ids = [i for i, _, source, _ in made if (source == "hot") == hot]
        x = Q.vectors(np.array([Q.counts(made[i][1].encode()) for i in ids], dtype=float))
        want = brute_models(x)
        got = np.array([found[i]["distance"] for i in ids])
        assert np.array_equal(want > Q.CUTOFF, got > Q.CUTOFF)
        clean = want <= Q.CUTOFF
        assert np.corrcoef(want[clean], got[clean])[0, 1] > 0.97 and abs(np.median(got / want) - 1) < 0.15


def test_verdict_is_that_of_any_layout(make_docs, mixed):
    made, _ = mixed
    a, b = ({r["doc_id"]: r["kept"] for r in Q.quality(make_docs(made, parts)).collect()} for parts in (1, 7))
    assert a == b


def test_labelled_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    r = (Q.quality(read(spark, sf, "documents")).join(read(spark, sf, "labels"), "doc_id").filter("NOT base_failed")
         .agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("clean"),
              F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("junk")).first())
    assert r["clean"] > 0.995 and r["junk"] < 0.05


def test_identical_rows_and_empty_table(make_docs):
    text = " ".join(f"word{i}" for i in range(60))
    rows = Q.quality(make_docs([(i, text) for i in range(50)])).collect()
    assert len(rows) == 50 and all(r["kept"] for r in rows)
    assert Q.quality(make_docs([])).count() == 0
