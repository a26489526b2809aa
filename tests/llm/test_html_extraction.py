"""Main text of made-up pages, and all of the test pages against their article."""

import html
import re

import pytest

from clearwell.llm.common import table
from clearwell.llm.html_extraction import extracted, main_text

LONG = "A sentence that is long enough, with commas, to count as prose in a page of its own."
NAV = "<nav><ul><li><a href='/a'>One</a><li><a href='/b'>Two</a></ul></nav>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("   \n", ""),
        ("just text &amp; no tags", "just text & no tags"),
        ("<p>a<p>b<div><b>c", "a\nb\nc"),
        (f"<body>{NAV}<article><h1>T</h1><p>{LONG}</p><p>short</p></article><footer>f</footer>", f"T\n{LONG}\nshort"),
        (f"<div class='content'><p>{LONG}<br>x\n  y</p></div><div id='sidebar'><p>{LONG}</p></div>", f"{LONG} x y"),
        (f"<main><section><p>{LONG}</p></section><section><p>{LONG}2</p></section></main>", f"{LONG}\n{LONG}2"),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG}</p></section></article>", LONG),
        (f"<div class='cookie-notice'><p>{LONG}{LONG}</p></div><div><h1>T</h1><p>{LONG}</p></div>", f"T\n{LONG}"),
        (f"<header><p>{LONG}</p></header><div><p>{LONG}</p><form><p>{LONG}</p></form></div>", LONG),
        (f"<article><header><h1>T</h1></header><p>{LONG}</p><aside>{LONG}</aside></article>", f"T\n{LONG}"),
        (f"<article><p>{LONG}</p><ul><li>one<li>two</ul></article>", f"{LONG}\none\ntwo"),
        (f"<article><p>{LONG}</p><ul><li><a href=x>one more</a><li><a href=y>two</a></ul></article>", LONG),
        (f"<script>var a='<p>{LONG}</p>';</script><style>p{{}}</style><!-- <p>{LONG}</p> --><p>{LONG}</p>", LONG),
        (f"<p>{LONG} &lt;b&gt; &eacute;&#8211;&#x41; &nope; AT&T&nbsp;x</p>", f"{LONG} <b> é–A &nope; AT&T x"),
        (f"<p>{LONG}</p><p hidden>{LONG}</p><div style='display: none'>{LONG}</div>", LONG),
        (f"<p title='a > b'>{LONG}</p><p class=\"x'y\">{LONG}2</p>", f"{LONG}\n{LONG}2"),
        (f"<article><table><tr><td>{LONG}<td>b</table><pre>x\n  y</pre></article>", f"{LONG}\nb\nx y"),
        (f"<article><p>{LONG}</p></article></div></div><script>", LONG),
        (f"<article class='ad-free share'><p>{LONG}</p></article>", LONG),
        (f"<div class='content with-sidebar'><p>{LONG}</p><div class='sidebar-content'>{LONG}</div></div>", LONG),
        (f"<article><p>{LONG}</p><article class='comment-body'><p>{LONG}</p></article></article>", LONG),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body style='overflow:hidden'><article style='overflow: hidden'><p>{LONG}</p></article></body>", LONG),
        (f"<body class='overflow-hidden'><div class='overflow-hidden'><p>{LONG}</p></div></body>", LONG),
        (f"<p>{LONG} <a href='/hidden-gems'>gems</a> and <a title='The hidden cost' href=x>cost</a></p>", f"{LONG} gems and cost"),
        (f"<body class='hidden'><main class='hidden'><p>{LONG}</p></main></body>", LONG),
        (f"<p data-x='hidden' title='display:none aria-hidden=true'>{LONG}</p>", LONG),
        (f"<p data-hidden=1 hidden=until-found>{LONG}</p><p style='content:\"visibility:hidden\"'>{LONG}2</p>", f"{LONG}\n{LONG}2"),
        (f"<p class='a hidden'>{LONG}</p><p hidden=''>{LONG}</p><p HIDDEN class=x>{LONG}</p><p>{LONG}2</p>", f"{LONG}2"),
        (f"<p>{LONG}<span aria-hidden=true>x</span></p><p style='color:red; VISIBILITY : hidden'>{LONG}</p>", LONG),
        (f"<p>{LONG}<span style=display:none>x</span><b style='display:none !important'>y</b></p>", LONG),
    ],
)
def test_only_hidden_elements_go(page, text):
    assert main_text(page) == text


SOURCES = "".join(f"<li><a href=x{k}>A source of some length</a> Author {k}, in {1900 + k}" for k in range(3))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><p>{LONG}</p><section id='discussion'><h2>D</h2><p>{LONG}2</p></section></article>", f"{LONG}\nD\n{LONG}2"),
        (f"<article><p>{LONG}</p><section id='related-work'><p>{LONG}2</p></section></article>", f"{LONG}\n{LONG}2"),
        (f"<article><p>{LONG}</p><div class='search-algorithms'><p>{LONG}2</p></div></article>", f"{LONG}\n{LONG}2"),
        (f"<article><p>{LONG}</p><h2 id='privacy'>Privacy</h2><p>{LONG}2</p></article>", f"{LONG}\nPrivacy\n{LONG}2"),
        (f"<div class='social-science'><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>", f"{LONG} x=1 holds."),
        (
            f"<article><p>{LONG}</p><ul>{SOURCES}</ul></article>",
            "\n".join([LONG, *(f"A source of some length Author {k}, in {1900 + k}" for k in range(3))]),
        ),
        (
            f"<article><p>{LONG}</p><ul><li><a href=x>one more</a><li><a href=y>two</a></ul><p>{LONG}2</p></article>",
            f"{LONG}\none more\ntwo\n{LONG}2",
        ),
        (f"<article><p>{LONG}</p><div id='comments'><div class='comment'><p>{LONG}2</p></div></div></article>", LONG),
        (f"<article><p>{LONG}</p><div id='related'><a href=x>{LONG}</a></div></article>", LONG),
        (f"<div class='related-articles'><p>{LONG}</p></div><div><p>{LONG}2</p></div>", f"{LONG}2"),
        (f"<div class='sidebar-right'><p>{LONG}</p></div><div class='main-content'><p>{LONG}2</p></div>", f"{LONG}2"),
    ],
)
def test_names_alone_drop_no_prose(page, text):
    assert main_text(page) == text


def test_deep_long_and_broken_pages_end():
    assert main_text("<div>" * 3000 + LONG + "</div>" * 3000) == LONG
    assert len(main_text("<p>" + "word, " * 200_000)) == 6 * 200_000 - 1
    assert main_text("<" * 50_000) == "<" * 50_000
    assert main_text("<a '" * 2000 + ">x") is not None


def test_test_pages_are_their_articles(spark):
    def article(page):
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        return "\n".join(b for b in blocks if b)

    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    rows = extracted(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


def test_edge_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", f"<p>{LONG}</p>", 1, "x"), (1, "u", f"<p>{LONG}</p>", 1, "x"), (None, None, None, None, None), (2, "v", "", 0, "")]
    found = extracted(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "u", LONG, len(LONG))] * 2 + [(2, "v", "", 0), (None, None, "", 0)]
    assert extracted(spark.createDataFrame([], schema)).collect() == []
