import itertools
import random

import numpy as np
import pytest

from ledgerflow.llm import mincut_extract as mx

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<script>var t="</p>";</script><div class="cookie-banner">We use cookies.</div><div id="content"><article><h1>Great &amp; good</h1>
<p><b>First paragraph of the   article, with text.<br><p>Second one&nbsp;here, which is longer than the first one is.</p>
<div class="ad">Buy this now!</div><p>Third paragraph ends the article, as it should.</article></div>
<section class="comments"><h2>Comments</h2><p>Nice article, thank you for it.</p></section>
<aside>Related stories</aside><form><input><label>Your mail</label><button>Send</button></form><footer>&copy; host</footer></body></html>"""
TEXT = ("Great & good\n\nFirst paragraph of the article, with text.\n\nSecond one here, which is longer than the first one is.\n\n"
        "Third paragraph ends the article, as it should.")


def _cost(score, edges, side):
    return (sum(x for x, s in zip(score, side) if x > 0 and not s) - sum(x for x, s in zip(score, side) if x < 0 and s)
            + sum(w for a, b, w in edges if side[a] != side[b]))


def test_min_cut_is_least():
    rng = random.Random(4)
    for _ in range(400):
        n = rng.randrange(1, 9)
        score = [round(rng.uniform(-2, 2), 2) for _ in range(n)]
        edges = [(a, b, round(rng.uniform(0, 1.2), 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        best = min(_cost(score, edges, s) for s in itertools.product([False, True], repeat=n))
        assert abs(_cost(score, edges, mx.min_cut(score, edges)) - best) < 1e-9


def test_smoothness_decides_a_doubtful_block():
    assert mx.min_cut([3.0, -0.5, 3.0], [(0, 1, 0.6), (1, 2, 0.6)]) == [True, True, True]
    assert mx.min_cut([-3.0, 0.5, -3.0], [(0, 1, 0.6), (1, 2, 0.6)]) == [False, False, False]


@pytest.mark.parametrize("page,blocks", [
    ("", []), ("<", ["<"]), ("<p>a<p>b", ["a", "b"]), ("<a href='x>y'>z</a>", ["z"]), ("<script>1<2</script>after", ["after"]),
    ("<!-- open", []), ("<script>open", []), ("a &amp; b&#x41; &lt;p&gt;", ["a & bA <p>"]), ("<ul><li>a<li>b</ul>", ["a", "b"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("x<br>y \n z", ["x y z"]), ("<div>x</p>y", ["x", "y"]),
    ("<p>cut off in a <b", ["cut off in a <b"]), ("</div></p>z", ["z"]), ("<P CLASS=x>q</P>", ["q"])])
def test_blocks(page, blocks):
    assert [b.text for b in mx.blocks_of(page)] == blocks


def test_article_without_the_rest():
    assert mx.main_text(PAGE.format(), mx.PRIOR) == TEXT


ARTICLE = ("<p>First paragraph of the article, with text that is long enough.</p><h2 id=\"legal\">Legal matters, told</h2>"
           "<section id=\"related-work\"><p>Other papers have looked at this question, at length.</p></section>"
           "<figure><img src=a><figcaption>A caption of the figure, with its words.</figcaption></figure>"
           "<p>The formula <math><mi>x</mi><mo>=</mo><mn>7</mn></math> holds, as we have seen before.</p>"
           "<p><object>A described drawing, shown in words.</object></p>")
KEPT = ["First paragraph of the article, with text that is long enough.", "Legal matters, told",
        "Other papers have looked at this question, at length.", "A caption of the figure, with its words.",
        "The formula x=7 holds, as we have seen before.", "A described drawing, shown in words."]


@pytest.mark.parametrize("page", [
    "<body><article>{}</article>", "<body class='with-sidebar'><article>{}</article>", "<main class='content no-sidebar'>{}</main>",
    "<article class='post share-enabled'>{}</article>", "<body class='page-search popular'><main id='no-menu'>{}</main>",
    "<div class='content has-banner'>{}</div>"])
def test_article_keeps_captions_formulas_and_anchored_parts(page):
    page = page.format(ARTICLE + "<div class='sidebar'><p>Buy our things now, please.</p></div>")
    assert mx.main_text(page, mx.PRIOR).split("\n\n") == KEPT


@pytest.mark.parametrize("page", [
    "<article class='comment'><p>Nice article, thank you for it.</p></article>", "<section id='comments'><p>Nice article, thank you.</p></section>",
    "<main><section id='related'><p>Related stories, of other days.</p></section></main>", "<section class='related-posts'><p>More stories.</p></section>"])
def test_what_says_boilerplate_goes(page):
    assert mx.main_text(page, mx.PRIOR) == ""


ROWS = "<table><tr><th>Year</th><th>Rain</th></tr><tr><td>1985</td><td>12 mm</td></tr></table><ul><li>First</li><li>Second</li></ul>"


@pytest.mark.parametrize("inside, kept", [
    ("<p>The numbers of the years are told in this table.</p>" + ROWS,
     ["The numbers of the years are told in this table.", "Year", "Rain", "1985", "12 mm", "First", "Second"]),
    ("<div class='related-work'><p>Other papers have looked at this.</p></div><p>And so do we, in this one.</p>",
     ["Other papers have looked at this.", "And so do we, in this one."]),
    ("<p class='intro share'>The share of the rain in a year, told.</p><p class=meta-analysis>All studies were put together.</p>",
     ["The share of the rain in a year, told.", "All studies were put together."]),
    ("<p>One paragraph of the article, with its text.</p><div class='share-buttons'>Tell your friends</div><div class='related_posts'>"
     "<p>Other stories, of other days.</p></div><div id='post-meta'>by us</div>", ["One paragraph of the article, with its text."])])
def test_parts_of_an_article_by_whole_names(spark, inside, kept):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for weights in (mx.PRIOR, mx.fit(pages)):
        assert mx.main_text(f"<nav><a href=a>Home</a></nav><article>{inside}</article><footer>end</footer>", weights).split("\n\n") == kept


def test_references_are_decoded_within_a_text():
    assert [b.text for b in mx.blocks_of("<p>a &am<b>p; b</b> &lt;i&gt;</p>")] == ["a &amp; b <i>"]


@pytest.mark.parametrize("unit", ["a <b ", "a < b ", "<!a ", "<b '", "<b><center>", "</b ", "<!--a ", "<div>x"])
def test_broken_pages_take_linear_time(unit):
    import time
    for end in ("", ">"):
        page, begin = unit * (1_000_000 // len(unit)) + end, time.process_time()
        mx.blocks_of(page)
        assert time.process_time() - begin < 8


def test_training_moves_weights_and_needs_no_labels():
    blocks = [b for b in mx.blocks_of(PAGE.format()) if b.said]
    w = mx.train(mx.features(blocks), np.array([b.said for b in blocks]))
    assert w.shape == mx.PRIOR.shape and not np.allclose(w, mx.PRIOR)
    assert mx.main_text(PAGE.format(), w) == TEXT
    assert (mx.train(np.zeros((0, len(mx.FEATURES))), np.zeros(0)) == mx.PRIOR).all()


def test_supplied_pages_equal_their_articles(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in mx.extract(pages, mx.fit(pages)).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert r.text == "\n\n".join(x for x in parts if x)


def test_cases(spark):
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    rows = [(1, None), (2, ""), (3, "plain words"), (3, "plain words"), (None, deep), (5, "<p>" + "word. " * 50_000)]
    pages = spark.createDataFrame([(i, p, "old") for i, p in rows], "page_id long, html string, text string")
    found = mx.extract(pages, mx.fit(pages)).collect()
    assert len(found) == 6 and [r.text for r in found[:2]] == ["", ""] and all(r.text is not None for r in found)
    assert found[5].text == ("word. " * 50_000).strip()
    none = pages.limit(0)
    assert mx.extract(none, mx.fit(none)).count() == 0
