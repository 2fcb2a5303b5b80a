from __future__ import annotations

import html
import re
import time
from pathlib import Path

import duckdb
import numpy as np
import pytest

from marketloom.llm.html_text import FEATURES, blocks_of, decide, extract, features_of, grow, labelled_blocks, main_text, tree

LONG = "word " * 60
PAGE = (
    "<html><head><title>T</title><script>var a='<p>x</p>';</script></head><body><header><a href=/>Home</a></header>"
    "<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class='cookie-notice'>We use cookies here a lot</div>"
    "<article><header><h1>Title &amp; more</h1></header><p>First&nbsp;one\n two<br>three <b>bold</b>.<p>Yes."
    "<div class=ad>Buy this now</div><form><label>Mail</label><input></form><p>Last &lt;b&gt; <a href=/x>link</a> text.</p>"
    "<section id='comments'><p>" + LONG + "</p></section></article><aside><p>" + LONG + "</p></aside>"
    "<footer>&copy; me</footer></body></html>"
)


def test_page():
    assert main_text(PAGE) == "Title & more\nFirst one two three bold.\nYes.\nLast <b> link text."


def test_page_without_an_article_element():
    page = f"<ul><li><a href=/>a</a><li><a href=/>b</a></ul><p>{LONG}</p><p>{LONG}</p><p><a href=/>{LONG}</a></p>"
    assert main_text(page) == "\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<", "<"), ("<p", ""), ("<!-- x", ""), ("<script>x", ""), ("<article>x", "x"),
        ("<article>a<p>b</article>c", "a\nb"), ("<article>" + "<p>a</p>" * 3 + "</article>", "a\na\na"),
        ("<ARTICLE><P CLASS='x>y'>a</P></ARTICLE>", "a"), ("<article>1 < 2 &#169; &bogus;</article>", "1 < 2 © &bogus;"),
        ("<article><pre>a\n  b</pre></article>", "a b"), ("<article>" + "ä" * 300_000 + "</article>", "ä" * 300_000),
        ("<article hidden>x</article>", ""), ("<nav><article>x</article></nav>", ""),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


TEXT = LONG.strip()


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article class='post has-sidebar'><p>{LONG}</p></article>", TEXT),
        (f"<article><p>{LONG}</p><p title='a hidden gem'>{LONG}</p></article>", f"{TEXT}\n{TEXT}"),
        (f"<article><div aria-hidden='false'><p>{LONG}</p></div></article>", TEXT),
        (f"<article><p>{LONG}</p><div aria-hidden='true'>{LONG}</div></article>", TEXT),
        (f"<article><div data-id='menu-3' data-class=ad><p>{LONG}</p></div></article>", TEXT),
        (f"<main><div id='social-history'><p>{LONG}</p></div></main>", TEXT),
        (f"<body><form action=/><nav><a href=/>a</a></nav><p>{LONG}</p><p>{LONG}</p></form></body>", f"{TEXT}\n{TEXT}"),
        (f"<p>{LONG}</p><p>{LONG}</p><form><p>Your name please</p></form>", f"{TEXT}\n{TEXT}"),
        (f"<article><p>{LONG}</p><div class='replies'><p>{LONG}</p></div></article>", TEXT),
        (f"<article><p>{LONG}</p></article><article class='comment'><p>{LONG}</p></article>", TEXT),
        (f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be<script>y</script>. {LONG}</p></article>", f"Let x=1 be. {TEXT}"),
    ],
)
def test_names_and_attributes(page, text):
    assert main_text(page) == text


def f1(tree, rows, labels):
    found = np.array([decide(tree, row) for row in rows.tolist()])
    return 2 * (found & labels).sum() / (found.sum() + labels.sum())


def test_the_tree_holds_on_other_pages_even_without_names():
    rows, labels = labelled_blocks()
    others, other_labels = labelled_blocks(range(1000, 1080))
    assert len(labels) > 5000 and f1(tree(), others, other_labels) > 0.98
    named = FEATURES.index("named")
    rows[:, named] = others[:, named] = 0
    assert f1(grow(rows, labels), others, other_labels) > 0.9


def test_the_tree_learns_its_table():
    rows, labels = labelled_blocks()
    right = [decide(tree(), row) == label for row, label in zip(rows.tolist(), labels.tolist(), strict=True)]
    assert sum(right) >= 0.99 * len(right)


def test_neighbours_are_features():
    rows = features_of(blocks_of("<p>a b c</p><p><a>x</a> y</p><p>z</p>"))
    assert rows[1].tolist()[:6] == [2, 0.5, 3, 0, 1, 0]


def test_time_is_linear_in_hostile_pages():
    started = time.perf_counter()
    for part in ("<", "<a ", "<!--", "<script>", "<head>", "<div>", "</div>", "<p class='"):
        main_text(part * (200_000 // len(part)))
    assert time.perf_counter() - started < 20


def test_table(spark):
    rows = [(1, "u", PAGE, 5), (None, None, None, 6), (1, "u", PAGE, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    found = extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    text = main_text(PAGE)
    assert sorted((tuple(r) for r in found.collect()), key=str) == [(1, "u", text, len(text))] * 2 + [(None, None, "", 0)]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="given tables not found")
def test_given_pages_have_exactly_their_article():
    for page_id, page in duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = [re.sub("<[^>]*>", " " if "<br" in x else "", x) for x in re.split(r"</?(?:p|h1)>", article)]
        lines = [" ".join(html.unescape(x).split()) for x in parts]
        assert main_text(page) == "\n".join(x for x in lines if x), page_id
