"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut at block-level tags into flat text blocks.  A block's features
are its word count and link density, those of its two neighbours, and what its
ancestors say (article, menu, advert ...).  Where the ancestors say nothing,
counts and neighbours decide: a short block between long ones is text, the same
block beside a list of links is not.  A decision tree fitted on the small
labelled table below keeps or drops each block; kept blocks are joined in page
order.  The tree is fitted once on the driver from that fixed table and sent to
the tasks; pages are extracted where they are read, without shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names by their role in HTML.
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
            "summary table tbody td tfoot th thead tr ul".split())
EMPTY = {"hr", "br", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
SILENT = {"svg", "math", "object", "canvas", "audio", "video", "map"}
#: Silent up to their end tag; left open (their end tags are often missing), up to the next block-level tag.
HELD = {"head", "title", "button", "select", "option", "datalist"}
RAW = "script|style|noscript|template|textarea|iframe|noframes|xmp|noembed"
CONTENT_TAGS = {"article", "main"}
BOILER_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "dir"}
# Words that name boilerplate as a part of a class name, and those that do only as the whole name.
BOILER_HINT = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|advertis\w*|adbox|adslot|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|"
    r"popup|modal|overlay|comments?|disqus|replies|respond|share|sharing|social|sidebar|"
    r"menu|menubar|nav\w*|breadcrumbs?|pagination|pager|footer|masthead|topbar|toolbar|related|"
    r"recommend\w*|newsletter|subscribe|signup|login|widgets?|copyright|disclaimer|contentinfo|"
    r"complementary|navigation)(?![a-z])|"
    r"(?<!\S)(?:alerts?|discussion|reviews|side|rail|foot|header|search|legal|form|tags|site-header|page-header|user-reviews|"
    r"search-form|search-box|side-rail|legal-notice|tag-list)(?!\S)")
COMMENT_HINT = re.compile(r"(?<![a-z])(?:comments?|replies|reply)(?![a-z])")
CONTENT_HINT = re.compile(r"(?<![a-z])(?:articles?|articlebody|content|main|post|entry|story|body|text|prose)(?![a-z])")

_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*+>|\Z)|"
                  r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
                  r"</?[a-zA-Z!?][^>]*+(?:>|\Z)", re.S | re.I)
_HINTS = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HEADING = re.compile(r"h[1-6]$")

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "in_article",
            "in_boilerplate", "boilerplate_name", "content_name", "heading"]

# The labelled table: small pages; the letters say of each block, in order, whether it is text (T) or boilerplate (B).
LABELLED = [
    ("""<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News today</a></ul></nav><div class=ad>Buy two get one free
     this week only at our shops.</div><article><h1>River floods old town</h1><p>The river rose above its banks on
     Monday night and filled the cellars of the old town within two hours.</p><p>Quickly.</p><p>Nobody was hurt, the
     mayor said, but <a href=/x>several bridges</a> stay closed until engineers have looked at them.</p></article>
     <footer>&copy; example &middot; All about us and our services here.</footer>""", "BBBTTTTB"),
    ("""<header><h1><a href=/>The Daily Sample</a></h1><p>News since 1901 for everybody in town</p></header><main>
     <h2>Bread prices</h2><p>Prices of bread went up again last month, the third time this year, as mills paid more.</p>
     <blockquote>We had no choice, said one baker.</blockquote><ul><li>Rye: up four percent</li><li>Wheat: up six</li>
     </ul><p>Short end.</p></main><aside><h3>Most read</h3><ul><li><a href=/1>Ten walks for the weekend</a></li>
     <li><a href=/2>Storm warning lifted</a></li></ul></aside><footer><p>Imprint</p><p>Write to us at the address
     below if you have any question about this site or the paper.</p></footer>""", "BBTTTTTTBBBBB"),
    ("""<div id=cookie-notice><p>We use cookies to make this site work and to learn how people use it every day.</p>
     </div><div class=menu><a href=/a>Start</a> <a href=/b>Articles</a></div><div class=post-content><h1>A walk</h1>
     <p>We left before dawn and followed the stream until the path turned up into the woods above the mill.</p>
     <p>Then rain.</p><p>At noon the sky cleared and we could see three valleys and the lake behind them.</p></div>
     <div class=comments><p>Lovely story, thanks for sharing it with all of us, I walked there last year too.</p>
     <p>Me too!</p></div><div class=footer>Contact and more about the people who write this page.</div>""",
     "BBTTTTBBB"),
    ("""<article><header><h1>Two moons</h1></header><p>Seen from the station the small moon crosses the large one every
     nine days.</p><div class=share><a href=/s>Share</a> <a href=/t>Tell a friend</a></div><p>Its shadow takes less
     than a minute.</p><aside class=related><p>Also read how the station was built in the years before the war.</p>
     </aside><form><p>Sign up for our letter and get it every Sunday morning.</p></form><p>Tides hardly change.</p>
     <section id=comments><h3>Reader comments</h3><p>I saw it from my garden with a small telescope in clear weather.
     </p></section></article>""", "TTBTBBTBB"),
    ("""<body><div class=topbar>Call us any day from eight to six for free advice.</div><div><p>Plain pages without any
     marks still hold long paragraphs of text that go on for a good number of words, with few links.</p><p>Another
     long paragraph follows the first one, and it too speaks in whole sentences about one and the same thing.</p></div>
     <div><a href=/1>One</a> <a href=/2>Two</a> <a href=/3>Three</a></div>""", "BTTB"),
    ("""<nav><p>Choose one of the many subjects that we write about on this site every single day.</p></nav><article>
     <p>Word.</p></article><div class="ad banner">Only today: every second pair of shoes costs nothing at all, come and
     see for yourself in the shop round the corner.</div><article><h2>Second part</h2><p>More of the same story, told
     from the other side of the river.</p><p><a href=/v>See the full list of names in the annex</a></p></article>
     <div class=sidebar><p>About the author: she has written for us since the very first issue of this paper.</p>
     </div>""", "BTBTTTB"),
    ("""<main><div class=notice>This page was moved from our old site and may miss some of its pictures.</div><p>The
     text starts here and has a handful of words.</p><table><tr><td>Year</td><td>Count</td></tr></table><pre>one two
     </pre><div class=pagination><a href=/2>2</a></div></main><div class=legal>All rights reserved by the owners of the
     works shown on this page, whoever they may be.</div>""", "BTTTTBB"),
    ("""<form><div>Your name and address, please, so that we can send you the answer.</div></form><article><div>Text in
     a plain division of an article counts as text whatever its length.</div><h3>Part</h3><div>No.</div></article>
     <div id=respond><p>Leave a reply below and please be kind to the other readers of this page.</p></div><footer><ul>
     <li>Terms</li><li><a href=/p>Privacy</a></li></ul></footer>""", "BTTTBBB"),
    ("""<header><p>Welcome back to the town paper, read by more than ten thousand people each day of the week.</p></header>
     <aside><p>A long note beside the article, set in small type, that explains who pays for this site and why they
     do so.</p></aside><article><p>Yes.</p><p>The council voted late, nine to four, and went home.</p></article><menu>
     <li>Open</li></menu>""", "BBTTB"),
    ("""<article><h1>The mill</h1><p>The old mill by the bridge turns again after forty years, and bread is baked there on
     Fridays.</p><aside>The miller keeps a list of all who helped and sends them flour each spring.</aside><p>Its wheel
     is new, the stones are not, and the roof was laid by volunteers from three villages.</p><form>Ask for a tour of the
     mill by leaving your name here with us today.</form><p>Grain comes by boat when the water is high enough for it to
     pass the weir.</p><nav><a href=/1>Next story</a></nav><footer>Filed under bread by the people of the village paper
     some time ago.</footer></article>""", "TTBTBTBB"),
    ("""<main><p>Once more a longer paragraph opens the page and says in many words what is going to be told in it.</p><p>A
     second one goes on in the same way, with commas, and ends where it has to end.</p><nav>Go on to the next part or
     back to the one before this one.</nav><p>The third one is the last of the long ones and closes what was opened
     above.</p><aside><p>By the way.</p></aside><form><p>Send.</p></form><footer>Last changed on a Sunday.</footer>
     <p>Fin.</p></main>""", "TTBTBBBT"),
    ("""<div><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport and games</a></div><div><p>A page of nothing but plain
     divisions tells its story in paragraphs such as this one, which has no link at all.</p><p>It was short.</p><p>The
     next one has <a href=/l>a link</a> somewhere in the middle of its words, as texts often do.</p></div><div>
     <a href=/o>Older stories from last year</a></div><div><a href=/a>About</a> | <a href=/c>Contact us</a></div>""",
     "BTTTBB"),
    ("""<table><tr><td><a href=/1>Index of all pages</a></td><td><a href=/2>Map</a></td></tr></table><p>Old pages used tables
     for their menus and then plain paragraphs for what they had to say to their readers.</p><p>Like so.</p><center>
     <a href=/b>Back to the top</a></center>""", "BBTTB"),
    ("""<div><a href=/>Home</a> <a href=/w>World</a> <a href=/m>Money</a></div><div>Get our letter every day.</div>
     <div><a href=/log>Log in</a></div><p>The ferry to the island runs again from the first of May, after the pier was
     mended over the winter by its owners.</p><p>It is full.</p><p>Those who want to cross on a holiday should come
     early in the morning, because the boat takes only forty people at a time.</p><p>No dogs.</p><p>The last boat back
     leaves at eight in the evening from the lower pier, and it doesn't wait for anybody who comes late.</p><div>
     <a href=/i>Imprint</a> <a href=/p>Privacy</a></div><div>Copyright 2024 Sample Corp.</div>""", "BBBTTTTTBB"),
    ("""<div>Your town, your paper</div><div><a href=/>Start</a> <a href=/l>Local</a> <a href=/s>Sport</a></div><p>Bees have
     come back to the roofs of the museum, where three hives stood empty for the whole of last year.</p><p>Why now?</p>
     <p>Nobody knows for sure, but the gardens around the square were sown with clover in autumn, says the keeper.</p>
     <p>The honey is sold at the door from June on, in small jars, as long as there is any left of it.</p><div>
     <a href=/m>More stories</a> <a href=/n>Next</a></div><div>Follow us everywhere</div><div><a href=/c>Contact</a></div>
     <div>All rights reserved.</div>""", "BBTTTTBBBB"),
    ("""<p><a href=/b>Back to the list</a></p><p>Printed on Monday</p><p><a href=/e>Send by mail</a> <a href=/q>Print</a></p>
     <p>A tower of the old wall fell in the storm of last night, and stones lie across the road to the station.</p><p>A
     bus goes round.</p><p>Work on the wall will take until spring, the town says, and cost more than what was set
     aside.</p><p>There are <a href=/t>two other towers</a> that have to be looked at before the next storm comes.</p>
     <p><a href=/1>First</a> <a href=/2>Last</a></p><p>Seen by many people.</p>""", "BBBTTTTBB"),
    ("""<article><h1>Sources</h1><p>These three books were used for the pages above, all of them in the public library.</p>
     <ul><li><a href=/1>The river and its mills</a></li><li><a href=/2>Towers of the old wall</a></li><li><a href=/3>Bees
     in town</a></li></ul><p>Ask at the desk.</p><p><a href=/4>A longer list</a></p></article><div><a href=/>Home</a></div>
     <div>Open from nine.</div>""", "TTTTTTTBB"),
    ("<article><p>One line only.</p></article>", "T"),
    ("<article><h1>Name</h1><p>Short.</p></article>", "TT"),
    ("<article><p><a href=/o>Only a link</a></p></article>", "T"),
    ("<main><h2>Notes</h2><p>First.</p><p>Second one.</p><p><a href=/t>Third</a></p></main>", "TTTT"),
    ("""<article><p>Said.</p><p>Done.</p><p>A man who sold chairs in the street said that he had seen it all from there.</p>
     <p>Then.</p></article><div>Made in town.</div>""", "TTTTB"),
    ("<article><p>Here</p><ul><li><a href=/1>a</a></li><li><a href=/2>b</a></li></ul><p>and there.</p></article>", "TTTT"),
    ("""<div>Read us on paper too</div><p>A plain page may begin at once with a long paragraph that says what has to be said
     in it.</p><p>It may end with one just as long, after which nothing at all follows on the whole of the page.</p>""", "BTT"),
    ("""<p>A single paragraph of many words is the text of a page that has nothing else to show to those who read it.</p>""",
     "T"),
    ("""<p>Of two long paragraphs on a page without any marks the first one stands at the very top of the page.</p><p>The
     second one stands at its end, and both of them are its text, as there is nothing else on it.</p><p>All rights
     reserved.</p>""", "TTB"),
    ("""<div>Sign up today</div><h1>Of stones</h1><p>Stones were cut on the hill above the town for as long as anybody there
     can remember, says a book.</p><p>It is hard work and was never paid well, which is why only a few still do it.</p>
     <div>Share this page</div>""", "BTTTB"),
    ("""<h1>Of ropes</h1><p>Ropes are made from hemp by walking backwards along a path that is longer than the rope will
     be.</p><p>Not easy.</p><p>A good maker walks thirty miles a day and doesn't go anywhere at all, as the saying has
     it.</p><div>Call us now</div><div><a href=/>Top</a></div>""", "TTTTBB"),
    ("""<div><a href=/>Home</a></div><div>Log in here</div><div><a href=/x>Help</a></div><h1>Of salt</h1><p>Salt came up the
     river in flat boats and was weighed at the gate, where a tax was paid on every sack.</p><div><a href=/y>All
     pages</a></div><div>Open all day</div>""", "BBBTTBB"),
    ("""<nav><ul><li><a href=/>Home</a><li><a href=/2>All our pages by date</a></ul></nav><div class=ad>Buy a new roof before
     the autumn storms and pay for it in the spring, with no interest at all for those who order by the end of May.</div>
     <div class=banner><p>Three weeks of free reading for everybody who orders our paper in the course of this month, at home
     or in any shop.</p><p>It ends by itself and you never have to write to us to put an end to it, which is a promise we
     keep.</p></div><article><h1>Of nets</h1><p>Nets dry on the wall.</p></article><div class=comments><p>I have seen these
     nets myself when I was there in the summer, and they were far longer than what the text here says about them.</p><p>My
     father made such nets all his life, and he would have liked this text, thank you for having written it down.</p></div>
     <div class=sidebar><p>The writer of these pages lives on the coast and has made three films about people who work on
     the sea.</p></div>""", "BBBBBTTBBB"),
    ("""<div class=content><p>The text of a page may stand in a division that is named for it, with long paragraphs such as this
     first one here.</p><p>A second paragraph of about that length follows, and tells the rest of what there is to be told
     today.</p></div><div class=related><p>Read in our next issue why the harbour was built on the wrong side of the bay, and
     who was paid for it.</p></div><div id=comments><p>Well told, but the second part could have been longer, as there is much
     more to say about all of this.</p><p>I don't agree with what was said above, for the harbour had been there before the
     town was founded.</p></div><div class=cookie-bar><p>This site keeps small files on your machine so that it knows you when
     you come back on another day.</p></div><div class=newsletter><p>Every Sunday we send a letter with the best texts of the
     week to all who ask for it, for nothing.</p></div>""", "TTBBBBB"),
    ("""<div class=notice><p>We are moving to a new machine on Saturday, and these pages may be slow or missing for an hour or two
     then.</p></div><div class=promo>A book with the hundred best pictures of the year can be had at our desk for ten crowns
     until it is sold out.</div><h1>Of wells</h1><p>Wells were dug by hand down to forty feet, and one man stood below while
     two others pulled up the earth.</p><div class=ad>Pumps of all sizes, made to last, brought to your door and put in by
     people who know how to do it.</div><p>Many of them still give water today, although hardly anybody goes there to fetch it
     with a bucket.</p><div class="social share"><p>Tell all your friends about this page and ask them what they think of the
     wells in their own town or village.</p></div>""", "BBTTBTB"),
]


def blocks(html: str | None) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """Flat text blocks: (text, words, words in links, flags as in FEATURES from in_article on)."""
    out: list[tuple[str, int, int, tuple[int, ...]]] = []
    stack: list[tuple[str, int, int, int, int]] = []  # tag, in_article, in_boilerplate, bad name, good name
    text: list[str] = []
    linked: list[str] = []
    silent, anchors = 0, 0
    held, open_end = "", False
    next_end: dict[str, int] = {}  # of each name: place of the next end tag, as far as looked for

    def flush() -> None:
        if text:
            words = unescape("".join(text)).split()
            if words:
                top = stack[-1] if stack else ("", 0, 0, 0, 0)
                heading = any(_HEADING.match(s[0]) for s in stack[-2:])
                out.append((" ".join(words), len(words), len(unescape(" ".join(linked)).split()),
                            (*top[1:], int(heading))))
        text.clear()
        linked.clear()

    def closes(name: str, at: int) -> bool:
        """Whether the element's end tag comes before another start of that name."""
        if next_end.get(name, -1) < at:
            next_end[name] = lower.find(f"</{name}", at) if next_end.get(name) != len(lower) else len(lower)
            if next_end[name] < 0:
                next_end[name] = len(lower)
        return next_end[name] < len(lower) and lower.find(f"<{name}", at, next_end[name]) < 0

    html, at = html or "", 0
    lower = html.lower()
    for m in _TAG.finditer(html):
        if m.start() > at and not silent and not held:
            part = html[at:m.start()]
            text.append(part)
            if anchors:
                linked.append(part)
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if held and open_end and name in BLOCK:
            held = ""
        if name in HELD:
            if m["end"]:
                held = "" if name == held else held
            elif not held and not m["attrs"].endswith("/"):
                held, open_end = name, not closes(name, at)
        elif name in SILENT:
            silent = max(0, silent + (-1 if m["end"] else 1)) if not m["attrs"].endswith("/") else silent
        elif name == "body":
            silent, held = 0, ""
        elif name == "a":
            anchors = 0 if m["end"] else 1
        elif name == "br":
            if not silent and not held:
                text.append(" ")
        if name not in BLOCK:
            continue
        flush()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    anchors = 0
                    break
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if name in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
            stack.pop()
        if name in EMPTY or m["attrs"].endswith("/"):
            continue
        _, article, boiler, bad, good = stack[-1] if stack else ("", 0, 0, 0, 0)
        names = " ".join("".join(x) for x in _HINTS.findall(m["attrs"])).lower().replace("_", "-")
        if name in CONTENT_TAGS:
            article = 1
        if name in BOILER_TAGS or (name == "header" and not article):
            boiler = 1
        if names and name != "body":
            # An article is one whatever its class says, unless it stands in boilerplate or is a reader's comment.
            bad |= bool((COMMENT_HINT if name in CONTENT_TAGS else BOILER_HINT).search(names))
            good |= bool(CONTENT_HINT.search(names))
        stack.append((name, article, boiler, int(bad), int(good)))
    if at < len(html) and not silent and not held:
        text.append(html[at:])
    flush()
    return out


def feature_rows(found: list[tuple[str, int, int, tuple[int, ...]]]) -> np.ndarray:
    own = np.array([(w, n / w) for _, w, n, _ in found], dtype=float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    flags = np.array([f for *_, f in found], dtype=float).reshape(-1, 5)
    return np.column_stack([own, np.vstack([edge, own])[:-1], np.vstack([own, edge])[1:], flags])


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
    """CART on the Gini index: nested (feature, threshold, low side, high side), leaves are shares of class 1.

    Ties go to the earlier feature: counts before what ancestors say.
    """
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return float(y.mean())
    gini = lambda part: len(part) * 2 * part.mean() * (1 - part.mean()) if len(part) else 0.0
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] < cut
            if min(low.sum(), (~low).sum()) < least:
                continue
            cost = gini(y[low]) + gini(y[~low])
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, cut)
    if best is None or best[0] >= gini(y) - 1e-9:
        return float(y.mean())
    _, f, cut = best
    low = x[:, f] < cut
    return f, float(cut), fit_tree(x[low], y[low], depth - 1, least), fit_tree(x[~low], y[~low], depth - 1, least)


def predict(tree, row: np.ndarray) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


def labelled_rows(pages: list[tuple[str, str]] = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and classes of the labelled table's blocks."""
    xs, ys = [], []
    for html, marks in pages:
        found = blocks(html)
        if len(found) != len(marks):
            raise ValueError(f"{len(marks)} labels for the blocks {[b[0][:30] for b in found]}")
        xs.append(feature_rows(found))
        ys += [m == "T" for m in marks]
    return np.vstack(xs), np.array(ys, dtype=float)


def main_text(html: str | None, tree) -> str:
    """Kept blocks joined by one line feed; null and empty pages give an empty text."""
    found = blocks(html)
    rows = feature_rows(found)
    return "\n".join(b[0] for b, row in zip(found, rows, strict=True) if predict(tree, row) >= 0.5)


def extract(pages: DataFrame, html_column: str = "html", labelled: list[tuple[str, str]] = LABELLED) -> DataFrame:
    """All columns of ``pages`` but the html, and text, n_chars (code points); one row per page.

    Columns of ``pages`` that are named text or n_chars are replaced.
    """
    tree = fit_tree(*labelled_rows(labelled))
    keep = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    rows = pages.select(*keep, F.col(html_column).cast("string").alias("_html"))
    kind = pages.select(*keep).schema.add("text", T.StringType()).add("n_chars", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, tree) for h in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, kind)
