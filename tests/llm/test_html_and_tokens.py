"""Page extraction and trie token counts."""

from __future__ import annotations

import math
import re
from html import unescape

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import AWKWARD_ROWS

from ontime.llm.html_blocks import blocks, extract, feature_rows, fit_tree, labelled_rows, main_text, predict
from ontime.llm.token_trie import BYTE_PENALTY, MARK, token_counts, trie_counts, vocabulary

TREE = fit_tree(*labelled_rows())


def test_tree_fits_its_labelled_table():
    x, y = labelled_rows()
    right = [(predict(TREE, r) >= 0.5) == bool(v) for r, v in zip(x, y, strict=True)]
    assert np.mean(right) > 0.97


def article_text(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_pages_give_their_articles(sf):
    for row in pq.read_table(f"/root/testdata/{sf}/pages.parquet").to_pylist():
        assert main_text(row["html"], TREE) == article_text(row["html"]), row["page_id"]


CASES = [
    (None, ""), ("", ""), ("<html><body></body></html>", ""),
    ("<article><p>a &amp;amp; b&nbsp;c &lt;d&gt; &#233; &eacute;</p></article>", "a &amp; b c <d> é é"),
    ("<article><p>one\n\t two<br>three</p><p></p><p>four</p></article>", "one two three\nfour"),
    ("<article><p>kept</p><script>var a = '<p>x</p>';</script><style>p{}</style><!-- <p>no</p> --></article>", "kept"),
    ("<article><p>left <b>bold <i>both</b> on</p><p title='a > b'>quoted</p></article>", "left bold both on\nquoted"),
    ("<nav><a href=/>Home</a></nav><article><h1>T</h1><p>x < y and z</p><form>Name <input> <button>Send</button></form>"
     "</article><footer>f</footer>", "T\nx < y and z"),
    ("<article><p>story</p><div class='comments'><p>first!</p></div><section id=comments>second</section></article>",
     "story"),
    ("<article><p>open paragraph<p>next one<div>and a division</div>tail", "open paragraph\nnext one\nand a division\ntail"),
    ("<article><p>cut in a tag <a href=", "cut in a tag"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_page_cases(html, text):
    assert main_text(html, TREE) == text


def test_bodies_without_marks_keep_text_and_drop_link_lists():
    html = ("<div><a href=/1>One</a> <a href=/2>Two</a></div><p>" + "many words of plain text " * 5 + "</p><p>"
            + "and another paragraph of it " * 5 + "</p><div><a href=/3>Three</a> | <a href=/4>Four</a></div>")
    text = main_text(html, TREE)
    assert text.startswith("many words") and "One" not in text and "Three" not in text


def test_neighbours_are_features():
    rows = feature_rows(blocks("<p>a b c</p><p><a href=x>d</a></p>"))
    assert rows[0][:6].tolist() == [3, 0, 0, 0, 1, 1] and rows[1][:6].tolist() == [1, 1, 3, 0, 0, 0]


def test_extract_keeps_rows_and_replaces_clashing_columns(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "old", 9), (2, None, None, None, None),
            (2, None, None, None, None), (None, "v", "<article>" + "<p>long text</p>" * 5000, "", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in extract(pages).collect()), key=repr)
    long = "\n".join(["long text"] * 5000)
    assert got == sorted([(1, "u", "x", 1), (2, None, "", 0), (2, None, "", 0), (None, "v", long, len(long))], key=repr)
    assert extract(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert extract(pages.limit(0)).count() == 0


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_segment(word, pieces):
    """Best (score, fewest tokens) over all segmentations, by plain dynamic programming from the end."""
    floor = min(pieces.values()) + BYTE_PENALTY
    best = {len(word): (0.0, 0)}
    for i in range(len(word) - 1, -1, -1):
        n = len(word[i].encode())
        options = [(best[i + 1][0] + n * floor, best[i + 1][1] + n)]
        options += [(best[j][0] + pieces[word[i:j]], best[j][1] + 1) for j in range(i + 1, len(word) + 1)
                    if word[i:j] in pieces]
        best[i] = max(options, key=lambda o: (round(o[0], 9), -o[1]))
    return best[0]


@settings(max_examples=60, deadline=None)
@given(words=st.sets(st.text(alphabet="abcdeé東x", min_size=1, max_size=9), min_size=1, max_size=20))
def test_trie_equals_segmentation_of_each_word(words):
    pieces = {"a": -1.0, "b": -1.5, "ab": -2.0, "abc": -2.6, "c": -1.2, "cde": -2.2, "d": -3.1, "e": -2.9, "é": -4.0}
    ordered = sorted(words)
    for word, (count, score) in zip(ordered, trie_counts(ordered, pieces), strict=True):
        want = brute_segment(word, pieces)
        assert score == pytest.approx(want[0]) and count == want[1]


def test_token_counts_awkward_rows(awkward):
    pieces = vocabulary(MODEL)
    got = sorted((tuple(r) for r in token_counts(awkward, MODEL).collect()), key=repr)
    want = []
    for i, text in AWKWARD_ROWS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        scored = dict(zip(sorted(set(words)), trie_counts([MARK + w for w in sorted(set(words))], pieces), strict=True))
        want.append((i, len(words), sum(scored[w][0] for w in words), sum(scored[w][1] for w in words)))
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9, abs_tol=1e-9)


def test_token_counts_empty_table(make_docs):
    assert token_counts(make_docs([]), MODEL).count() == 0


LONG = "many words of plain text that go on and on for a while, " * 2


@pytest.mark.parametrize("html, text", [
    ("<article><p>a</p><select><option>x<option>y</select><p>rest</p></article>", "a\nrest"),
    ("<article><p>a</p><select><option>x<option>y<p>rest</p><p>more</p></article>", "a\nrest\nmore"),
    ("<article><p>a</p><button>Send<p>rest</p></article>", "a\nrest"),
    ("<article><p>a <button><div>Share</div></button></p><p>b</p></article>", "a\nb"),
    ("<article><p>a <label>named</label> b</p></article>", "a named b"),
    ("<head><title>T<body><article><p>a</p></article>", "a"),
    ("<article class=review><p>good film</p></article>", "good film"),
    ("<article><div class=form-group>a</div><div class=tag-line>b</div><div class=text-side>c</div>"
     "<div class=legal-analysis>d</div></article>", "a\nb\nc\nd"),
    ("<article><p>see</p><ul><li><a href=/1>one</a></li><li><a href=/2>two</a></li></ul></article>", "see\none\ntwo"),
])
def test_unclosed_elements_and_names_lose_no_text(html, text):
    assert main_text(html, TREE) == text


def test_counts_and_neighbours_decide_where_nothing_is_marked():
    """The same block is text between long paragraphs and none between lists of links; so is a long one for a short one."""
    links = "<div><a href=/>x y</a> <a href=/z>z</a></div>"
    between = lambda block, side: main_text(f"{side}<p>{block}</p>{side}<p>{LONG}</p>", TREE).split("\n")
    assert "It was short." in between("It was short.", f"<p>{LONG}</p>")
    assert "It was short." not in between("It was short.", links)
    assert between(LONG.strip(), links) == [LONG.strip()] * 2
    x, y = labelled_rows()
    for features in ([0], [1], [2, 3, 4, 5]):  # own words, own links, neighbours
        blind = x.copy()
        blind[:, features] = 0
        assert any((predict(TREE, a) >= 0.5) != (predict(TREE, b) >= 0.5) for a, b in zip(x, blind, strict=True))
