import re

from conftest import SMALL, values

from tallyfold.operators import pages as P

URL = "https://news.example/sport/x"


def one(html, url=URL):
    record = P.read_article(1, url, html)
    return record and dict(zip("id url title content category images date comments".split(), record))


def test_missing_parts():
    got = one("<div>nothing</div>")
    assert (got["title"], got["content"], got["date"]) == (P.NO_TITLE, P.NO_CONTENT, P.NO_DATE)
    assert (got["images"], got["comments"], got["category"]) == (0, 0, "sport")


def test_texts_are_stripped_and_joined():
    got = one("<h1> A <b> b </b> c<!-- x --> d</h1><h1>second</h1><p> x &amp; y </p><p>z<br> w</p>")
    assert got["title"] == "Abcd" and got["content"] == "x & y\nzw"


def test_empty_paragraphs():
    assert one("<p></p>")["content"] == P.NO_CONTENT
    assert one("<p></p><p> </p>")["content"] == "\n"
    assert one("<h1></h1>")["title"] == ""


def test_scripts_hide_tags_and_text():
    assert one("<p>a<script>var t='</p><img>';</script>b</p>")["content"] == "ab"
    assert one("<p>a<script>1</script>b</p>")["images"] == 0


def test_unclosed_paragraphs_end_at_the_next():
    assert one("<article><p>a<p>b</p>c</article>d")["content"] == "a\nb"
    assert one("<p>a<div>b</div>c")["content"] == "a"
    assert one("<p>a</b>c</p>")["content"] == "ac"  # an end tag that opens nowhere


def test_images_and_time():
    got = one("<img><img src=x/><IMG /><time> 5. 3. 2021 </time><time>no</time>")
    assert got["images"] == 3 and got["date"] == "5. 3. 2021"


def test_comments():
    anchor = '<a id="moot-linkin" href=x>%s</a>'
    assert one(anchor % "<b><span>Diskuse (12 příspěvků)</span></b>")["comments"] == 12
    assert one(anchor % "no span")["comments"] == 0
    assert one(anchor % "<span>none</span>") is None
    assert one(anchor % "" + "<span>7</span>")["comments"] == 0
    assert one("<a id=other><span>3</span></a>")["comments"] == 0


def test_unreadable_pages():
    assert one("<h1>a</h1>", "https://a") is None
    assert one(None) is None and one("<h1>a</h1>", None) is None


def test_job_drops_unreadable(rows):
    many = '<a id="moot-linkin"><span>%s</span></a>'
    pages = rows(
        "page_id long, url string, html string", (1, URL, "<h1>a</h1>"), (2, "x", "y"), (3, URL, None),
        (4, URL, "<h1>b</h1><![ x"), (5, URL, many % ("9" * 20)), (6, URL, many % ("9" * 9000)),
        (7, URL, "<h1>c</h1>" + many % (2**63 - 1)))
    got = values(P.extract_articles(pages), "page_id", "title")
    assert got[0] == (1, "a") and got[-1] == (7, "c") and {5, 6}.isdisjoint(i for i, _ in got)
    assert P.dropped_pages(pages).first()["n"] == 7 - len(got)
    assert P.extract_links(pages, None).filter("page_id = 4").count() == 0


def test_open_paragraphs_do_not_multiply():
    page = "<p>thirteen chars" * 8000
    assert len(one(page)["content"]) == 14 * 8000 + 7999


def test_links(rows):
    html = '<a class="x art-link" href="/1">a</a><a class=art-link-2 href="/2"></a><a class="art-link">b</a>'
    pages = rows("page_id long, html string", (1, html), (2, None))
    assert values(P.extract_links(pages)) == [(1, 0, "/1"), (1, 1, None)]
    assert values(P.extract_links(pages, None)) == [(1, 0, "/1"), (1, 1, "/2"), (1, 2, None)]


def test_contents_of_test_pages_by_brute_force(spark):
    """Paragraph texts found by scanning tags one by one with a list of open elements."""
    from html import unescape

    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = dict(values(P.extract_articles(spark.read.parquet(f"{SMALL}/pages.parquet")), "page_id", "content"))
    for page in pages:
        html = re.sub(r"(?s)<(script|style)[^>]*>.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", "<q/>", page["html"])
        stack, found = [], []
        for tag, text in re.findall(r"(<[^>]*>)|([^<]+)", html):
            name = re.sub(r"[</>\s].*", "", tag[1:].lstrip("/"))
            if text:
                for i in [i for n, i in stack if n == "p"]:
                    found[i].append(unescape(text).strip())
            elif tag.startswith("</"):
                if name in [n for n, _ in stack]:
                    while stack.pop()[0] != name:
                        pass
            elif name not in ("br", "meta", "q", "img", "link"):
                if name == "p":
                    if "p" in [n for n, _ in stack]:
                        while stack.pop()[0] != "p":
                            pass
                    found.append([])
                stack.append((name, len(found) - 1))
        assert got[page["page_id"]] == "\n".join("".join(p) for p in found)
