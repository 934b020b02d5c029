import html
import re
import time

import pytest
from conftest import SMALL

from tallyfold.llm import html_text as h
from tallyfold.llm import queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no";</script></head>
<body class="with-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, as all do. Do you agree, or not?</p></div>
<main><article class="post"><header><h1>Head &amp; shoulders</h1></header>
<p>First para, with <b>bold</b>er text.<br>Second line &#233;t&eacute;.
<p>Second, para. It has   several
 sentences, too.<blockquote>Quoted, words.</blockquote><ul><li>one thing<li>another</ul>
<form><label>Mail</label><input name=m></form><div class="ad">Buy now, and save. Lots of it, really!</div></article></main>
<aside><p>Related, things. To read, later on.</p></aside>
<section id="comments"><article class="comment"><p>Nice, text. I liked it, very much. Truly, I did, and more.</p></article></section>
<footer>&copy; me</footer></body></html>"""


def test_article_without_the_rest():
    assert h.main_text(PAGE) == (
        "Head & shoulders First para, with bolder text. Second line été. Second, para. It has several sentences, too. "
        "Quoted, words. one thing another")


def test_content_is_found_without_names():
    page = "<div>" + "".join(f"<span><a href=x>Menu {i}</a></span><div>Item {i}</div>" for i in range(9)) + "</div>"
    page += "<div><div><h2>Title</h2>" + "".join(
        f"<p>Sentence one, number {i}. And another, somewhat longer one, follows it here.</p>" for i in range(5)) + "</div></div>"
    text = h.main_text(page)
    assert text.startswith("Title Sentence one, number 0.") and "Menu" not in text and "Item" not in text


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("  ", ""), ("just, text", "just, text"), ("<p>a<![ x", "a"), ("<p>a <!-- open <p>b", "a"),
    ("<p>a<script>b", "a"), ("<p>a &am", "a &am"), ("<p>a &amp b &nosuch; &#x41;", "a & b &nosuch; A"), ("< p", "< p"),
    ("<a href='x>y'>t</a>", "t"), ("<nav>only</nav>", ""),
])
def test_broken_pages(page, text):
    assert h.main_text(page) == text


def test_time_grows_with_the_page():
    start = time.perf_counter()
    for page in ("<p>open, text " * 20_000, "<div>" * 20_000 + "x", "<div>deep, text " * 10_000, "<a " * 50_000,
                 "<ul><li>" * 10_000, "</p>" * 50_000, "<" * 100_000, "<div>" * 5000 + "</p><p>x," * 5000):
        h.main_text(page)
    assert time.perf_counter() - start < 60


def test_query_against_the_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = queries.op5(spark, SMALL).collect()
    assert sorted(r["page_id"] for r in found) == sorted(pages)
    for r in found:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        bare = html.unescape(re.sub(r"<[^>]+>", lambda t: "" if t[0] in ("<b>", "</b>") else " ", inner))
        assert r["text"] == " ".join(bare.split()) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def test_odd_rows(rows):
    df = rows("page_id long, url string, html string, text int, n_chars string", (None, None, None, 1, "x"),
              (1, "u", "", None, None), (1, "u", "", None, None), (2, "v", "<p>" + "word, " * 100_000, None, None))
    found = h.extract(df).collect()
    assert [r["n_chars"] for r in found] == [0, 0, 0, 599_999]
    assert h.extract(df.limit(0)).count() == 0
