from __future__ import annotations

import html
import re

import pytest
from skywarden.llm.maintext import lines, main_text, main_texts

LONG = "Plain words of a long enough paragraph, told once more so that it has over eighty characters in all."
LINKS = "".join(f'<li><a href="/{i}">a link to page {i}</a></li>' for i in range(6))


def page(body: str, head: str = "<title>Not this</title><style>p{}</style>") -> str:
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("body", [
    f"<nav><ul>{LINKS}</ul></nav><article><h1>Head</h1><p>{LONG}<p>Of.</article><footer>&copy; foot {LONG}</footer>",
    f'<header><p>{LONG}</p></header><div class="ad">{LONG}</div><article><h1>Head</h1><p>{LONG}</p>'
    f'<aside><p>{LONG}</p></aside><p>Of.</p></article><section id="comments"><article><p>{LONG}</p></article></section>',
    f'<div id="cookie-notice"><p>{LONG}</p><p>{LONG}</p></div><main><h1>Head</h1><p>{LONG}</p><form><p>{LONG}</p>'
    f'<label>Name</label><input name="x"></form><p>Of.</p></main><div class="sidebar"><p>{LONG}</p></div>',
    f'<div class="wrap"><ul>{LINKS}</ul><h1>Head</h1><p>{LONG}</p><p>Of.</p><ul>{LINKS}</ul></div>',
    f'<div class="has-sidebar"><div class="entry-content"><h1>Head</h1><div>{LONG}</div><div>Of.</div></div></div>',
    f'<article><header><h1>Head</h1></header><script>var t="</p>";</script><!-- <p>{LONG}</p> --><p>{LONG}</p><p>Of.</p>'
    f'<footer>by {LONG}</footer></article>',
    f'<ARTICLE><H1>Head</H1><P CLASS=lead>{LONG}</P><DIV STYLE="display: none">{LONG}</DIV><P>Of.</P></ARTICLE>',
    f'<div class="page-sidebar-menu"><article><h1>Head</h1><p>{LONG}</p><p title="it was hidden here">Of.</p></article></div>',
])
def test_article_without_the_rest(body):
    assert main_text(page(body)) == f"Head\n\n{LONG}\n\nOf."


def test_short_article_is_whole():
    assert main_text(page("<nav>x</nav><article><p>Is.</article>")) == "Is."


@pytest.mark.parametrize("raw, want", [
    ("a &amp; b &lt;c&gt; &#233;&#x263A; &copy &unknown;", "a & b <c> é☺ © &unknown;"),
    ("&amp;lt; stays", "&lt; stays"), ("one\n\t two<br>three", "one two three"), ("in<b>to</b> <i> one </i>", "into one"),
    ("a < b and c > d", "a < b and c > d"), ("x <3 y", "x <3 y"), ("tail <b", "tail"), ("quote <a title=\"x>y\">z</a>", "quote z"),
])
def test_text_of_a_block(raw, want):
    assert main_text(f"<article><p>{raw}</p></article>") == want


@pytest.mark.parametrize("raw", [
    None, "", "   ", "<", "<!--", "<script>var x", "<nav>only a menu</nav>", "<p>too short", "</p></div>", "<a href='x", "<p",
    f"<ul>{LINKS}</ul>"])
def test_nothing_to_keep(raw):
    assert main_text(raw) == ""


def test_unclosed_parts_end_with_what_holds_them():
    assert main_text(f"<article><p>{LONG}<aside><p>beside</article><p>after") == LONG
    assert main_text(f"<body><p>{LONG}<p>More") == f"{LONG}\n\nMore"
    assert main_text(f'<article><p>{LONG}<p class="ad">beside<p>More') == f"{LONG}\n\nMore"


def test_stretches_are_parted_by_a_valley():
    """Short text behind a list of links is a stretch of its own and goes; a long one stays."""
    assert main_text(page(f"<p>{LONG}</p><ul>{LINKS}</ul><p>By us</p>")) == LONG
    assert main_text(page(f"<p>{LONG}</p><ul>{LINKS}</ul><p>{LONG}</p>")) == f"{LONG}\n\n{LONG}"
    assert [x.linked > 0 for x in lines(f"<p>{LONG}</p><ul>{LINKS}</ul>") if x.parts] == [False] + [True] * 6


def test_very_long_and_deep_pages():
    many = "".join(f"<p>{LONG} {i}</p>" for i in range(3000))
    assert main_text(f"<article>{many}</article>").count("\n\n") == 2999
    deep = "<div>" * 30_000 + LONG + "</div>" * 30_000
    assert main_text(deep) == LONG


def test_table_with_odd_rows(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", 5, "x"), (1, "u", f"<article><p>{LONG}</p></article>", 5, "x"),
            (2, None, None, None, None), (None, "u", "", 1, "y"), (3, "u", "<article><p>é 😀</p></article>", 1, "y")]
    got = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string"))
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "u", LONG, len(LONG))] * 2 + [(2, None, "", 0), (None, "u", "", 0), (3, "u", "é 😀", 3)], key=repr)
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_given_pages_against_the_marked_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for p in pages:
        inner = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?(?:p|h1)>", inner)]
        assert main_text(p.html) == "\n\n".join(b for b in blocks if b)
