"""Operator 13: the cut against all labellings, pages by hand, and the articles of the given pages."""

import random
import re
import time
from html import unescape
from itertools import product

import pytest

from orderlake.llm import queries
from orderlake.llm.main_text import block_labels, labelled_blocks, main_text, with_main_text
from orderlake.llm.mincut import cheapest_labels, source_side


def cost(labels, gains, edges):
    return sum(-g for g, x in zip(gains, labels) if x) + sum(c for i, j, c in edges if labels[i] != labels[j])


@pytest.mark.parametrize("solve", [cheapest_labels, source_side])
def test_cut_is_the_cheapest_with_fewest(solve):
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randrange(1, 8)
        gains = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randrange(1, 7)) for _ in range(rng.randrange(12))]
        edges = [(i, j, c) for i, j, c in edges if i != j]
        found = solve(gains, edges)
        every = [(cost(x, gains, edges), sum(x), list(x)) for x in product([False, True], repeat=n)]
        assert (cost(found, gains, edges), sum(found), found) == min(every)


def test_cut_of_long_chains():
    rng = random.Random(1)
    n = 20_000
    gains = [rng.choice([-7, -3, 0, 0, 2, 6]) for _ in range(n)]
    edges = [(i, i + 1, 6) for i in range(n - 1)] + [(i, i + 2, 4) for i in range(n - 2)]
    started = time.time()
    cheapest_labels(gains, edges)
    assert time.time() - started < 20


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{color:red}</style>
<script>var a = "</p><p>no</p>"; if (a < 3) b();</script></head><body class="has-sidebar">
<header><h1>The Site</h1><form action=/s><input name=q><button>Go</button></form></header>
<nav><ul><li><a href="/a">Home</a><li><a href='/b'>News of today, and more of it.</a></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it a better site for all of us.</div>
<div id="page-with-sidebar"><article class="post"><header><h1>A&nbsp;headline</h1></header>
<p>First &lt;para&gt;graph,
   with <b>bold</b> and a <a href="x">link</a>.<br>After a break.
<p>Short.
<div class="ad">Buy this very good thing now, it is the best of all things there are.</div>
<!-- a comment <p>hidden</p> --><h2>Below</h2><ul><li>One item<li>Another <i>item</i></ul>
<blockquote>Quoted words, spoken by somebody.</blockquote><pre>two
  lines</pre><table><tr><td>cell<td>next cell</table>
<p><a href="y">A paragraph that is a link as a whole, but part of the article.</a></p>
<section id="comments"><h3>3 comments</h3><article><p>I do not agree with any of this, and I say so at length here.</p></article></section>
</article><aside><h2>Related</h2><p>Another article, of which this is the first sentence, and a second one.</p></aside></div>
<footer>&copy; 2020 The Site. All rights are reserved, and will be so for a long time.</footer>"""

WANTED = """A headline
First <para>graph, with bold and a link. After a break.
Short.
Below
One item
Another item
Quoted words, spoken by somebody.
two lines
cell
next cell
A paragraph that is a link as a whole, but part of the article."""


def test_page_by_hand():
    assert main_text(PAGE) == WANTED


LONG = "This is a long sentence of the text proper, and it goes on for a good while, until it ends. "


def test_page_without_article():
    page = (
        "<body><div class=top><a href=/>Home</a> <a href=/x>Other pages</a></div><div id=wrap><h1>Headline here</h1>"
        f"<p>{LONG * 3}<p>Ok.<p>{LONG}</div><div class='side-menu'><p>{LONG}</div>"
        "<ul><li><a href=1>Link one</a><li><a href=2>Link two</a><li><a href=3>Link three of them</a></ul>"
    )
    assert main_text(page) == "\n".join(["Headline here", (LONG * 3).strip(), "Ok.", LONG.strip()])


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("<", "<"),
        ("<p", ""),
        ("<!-- never closed <article><p>Text here.</p>", ""),
        ("<script>never closed <p>Text</p>", ""),
        ("<article>a < b &amp;amp; c > d &#x41;&notit;</article>", "a < b &amp; c > d A¬it;"),
        ("<article></p>Only one.</div></article></article>", "Only one."),
        ("<article><p title='a>b' data-x=\"<p>\">One.</p><p title=it's>Two isn't.</p></article>", "One.\nTwo isn't."),
        ("<article><b>un<i>closed</b> tags<p>next</i> one</article>after", "unclosed tags\nnext one"),
        ("<ARTICLE><P>Upper</P><BR/>case</ARTICLE>", "Upper\ncase"),
        ("<article>é 日本\x00x</article>", "é 日本\x00x"),
        ("<nav>Only a menu, no article at all.</nav>", ""),
        ("<article><p>x<table><tr><td><p>in</div></td></tr></table>y</p></article>", "x\nin\ny"),
        ("<head><meta charset=x><p>A head that does not end, with a paragraph of text in it.</p>", "A head that does not end, with a paragraph of text in it."),
        ("<form id=all><main><p>Page in a form.</p></main></form>", "Page in a form."),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>Yes.</p></article>", "Yes."),
    ],
)
def test_odd_markup(html, text):
    assert main_text(html) == text


def test_reading_is_linear():
    """Pages that make readers look ahead again and again."""
    for piece in ("<", "<p ", "<!", "<a b='", '<a b="', "</", "<!--", "&", "<p>", "<div>", "</b>", "<b>", "<script", "<a x=y ", "<p><b>", "<td>"):
        started = time.time()
        labelled_blocks(piece * 40_000)
        assert time.time() - started < 20, piece
    assert len(main_text(f"<article>{'<p>' + LONG}" * 1 + f"<p>{LONG}" * 20_000)) == 20_001 * len(LONG) - 1


def article(html):
    """The given pages' article, cut out by its tag."""
    inner = re.search("<article>(.*?)</article>", html, re.S).group(1)
    blocks = re.split("</?(?:p|h1|h2)>", inner)
    texts = [" ".join(unescape(re.sub("<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_given_pages(spark, sf_dir):
    rows = queries.QUERIES["op13_main_text"](spark, sf_dir).collect()
    pages = {r.page_id: r for r in queries.table(spark, sf_dir, "pages").collect()}
    assert len(rows) == len(pages)
    for row in rows:
        assert row.url == pages[row.page_id].url
        assert row.text == article(pages[row.page_id].html)
        assert row.n_chars == len(row.text)


def test_columns_repeats_and_nothing(spark):
    rows = [(1, "u", PAGE, "old", 3), (1, "u", PAGE, "old", 3), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = with_main_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars", "n_blocks"]
    assert sorted(tuple(r) for r in found.collect() if r.page_id) == [(1, "u", WANTED, len(WANTED), 11)] * 2
    assert [tuple(r) for r in found.collect() if not r.page_id] == [(None, None, "", 0, 0)]
    assert with_main_text(pages.limit(0)).collect() == []
    labels = block_labels(pages.limit(1)).orderBy("block").collect()
    assert "\n".join(r.text for r in labels if r.content) == WANTED
    assert any(r.text.startswith("We use cookies") and not r.content for r in labels)
