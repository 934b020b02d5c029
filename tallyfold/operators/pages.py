"""Article records and links out of raw HTML pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.values import url_segment

# Values of fields that a page lacks (fixed values).
NO_TITLE = "Název nenalezen"
NO_CONTENT = "Obsah nenalezen"
NO_DATE = "Datum nenalezeno"
COMMENT_ANCHOR = "moot-linkin"
LINK_CLASS = "art-link"

# Elements without an end tag, and elements whose text is not prose (fixed values).
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
NOT_PROSE = frozenset(["rp", "rt", "script", "style", "template"])

LARGEST = (1 << 63) - 1
ARTICLE_COLUMNS = (
    "page_id long, url string, title string, content string, category string, image_count long, "
    "publication_date string, comment_count long"
)


class PageReader(HTMLParser):
    """Collects the texts of interest while tags open and close.

    An end tag closes the nearest open element of its name and all inside it. A paragraph
    also ends, as in HTML, where an element begins that cannot be part of one, so the text
    read never exceeds that of the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.paragraphs: list[list[str]] = []
        self.first: dict[str, list[str]] = {}
        self.images = 0
        self.anchors: list[dict[str, str]] = []
        self._open: list[tuple[str, list[str] | None]] = []
        self._counts: Counter[str] = Counter()
        self._text: list[str] = []

    def read(self, html: str) -> PageReader:
        self.feed(html)
        self.close()
        self._flush()
        return self

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, tag in VOID)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, True)

    def _start(self, tag, attrs, closed):
        self._flush()
        if tag in ENDS_PARAGRAPH and self._paragraphs:
            self._close("p")
        known = {name: value or "" for name, value in attrs}
        sink = self._sink_for(tag, known)
        if not closed:
            self._open.append((tag, sink))
            self._counts[tag] += 1

    def _sink_for(self, tag, attrs) -> list[str] | None:
        if tag == "p":
            self.paragraphs.append([])
            return self.paragraphs[-1]
        if tag == "img":
            self.images += 1
        name = tag if tag in ("h1", "time") else None
        if tag == "a":
            self.anchors.append(attrs)
            if attrs.get("id") == COMMENT_ANCHOR:
                name = "comment anchor"
        if tag == "span" and any(s is self.first.get("comment anchor", ()) for _, s in self._open):
            name = "comment span"
        if name is None or name in self.first:
            return None
        self.first[name] = []
        return self.first[name]

    def handle_endtag(self, tag):
        self._flush()
        self._close(tag)

    def _close(self, tag):
        if not self._counts[tag]:
            return
        name = None
        while name != tag:
            name, _ = self._open.pop()
            self._counts[name] -= 1

    @property
    def _paragraphs(self) -> int:
        return self._counts["p"]

    def handle_data(self, data):
        self._text.append(data)

    def _flush(self, *_):
        text = "".join(self._text).strip()
        self._text.clear()
        if text and not any(self._counts[name] for name in NOT_PROSE):
            for _, sink in self._open:
                if sink is not None:
                    sink.append(text)

    handle_comment = handle_decl = handle_pi = unknown_decl = _flush

    def text_of(self, name: str) -> str | None:
        return "".join(self.first[name]) if name in self.first else None


def read_page(html: str | None) -> PageReader | None:
    """The page's texts, or None if the parser gives up on it."""
    if html is None:
        return None
    try:
        return PageReader().read(html)
    except (AssertionError, ValueError, IndexError, RecursionError):
        return None


def read_article(page_id, url, html) -> tuple | None:
    """One article record, or None for a page that cannot be read."""
    if url is None or url.count("/") < 3:
        return None
    page = read_page(html)
    if page is None:
        return None
    comments = 0
    said = page.text_of("comment span")
    if said is not None:
        number = re.search(r"\d+", said)
        if number is None:
            return None
        comments = int(number.group()) if len(number.group()) <= 20 else LARGEST + 1
        if comments > LARGEST:
            return None
    title, date = page.text_of("h1"), page.text_of("time")
    content = "\n".join("".join(p) for p in page.paragraphs)
    return (
        page_id, url, NO_TITLE if title is None else title, content or NO_CONTENT,
        url.split("/")[3], page.images, NO_DATE if date is None else date, comments,
    )


def extract_articles(pages: DataFrame) -> DataFrame:
    """Article records of ``pages (page_id, url, html)``.

    Pages that cannot be read are dropped one by one; ``dropped_pages`` counts them.
    """
    names = [part.split()[0] for part in ARTICLE_COLUMNS.split(", ")]

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = map(read_article, batch["page_id"], batch["url"], batch["html"])
            yield pd.DataFrame([r for r in rows if r is not None], columns=names)

    return pages.select("page_id", "url", "html").mapInPandas(read, ARTICLE_COLUMNS)


def extract_links(pages: DataFrame, css_class: str | None = LINK_CLASS) -> DataFrame:
    """Targets of the anchors of a class, or of all anchors, in page order."""

    def wanted(attrs: dict[str, str]) -> bool:
        return css_class is None or css_class in attrs.get("class", "").split()

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (page_id, pos, attrs.get("href"))
                for page_id, page in zip(batch["page_id"], map(read_page, batch["html"])) if page
                for pos, attrs in enumerate(filter(wanted, page.anchors))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "href"])

    return pages.select("page_id", "html").mapInPandas(read, "page_id long, pos long, href string")


def dropped_pages(pages: DataFrame) -> DataFrame:
    """The number of pages that give no article record, as ``n``."""
    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = map(read_article, batch["page_id"], batch["url"], batch["html"])
            yield pd.DataFrame({"n": [sum(row is None for row in rows)]})

    counted = pages.select("page_id", "url", "html").mapInPandas(read, "n long")
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def page_facts(pages: DataFrame) -> DataFrame:
    """First heading, image count and category by patterns, without Python."""
    heading = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return pages.select(
        "page_id", heading.alias("title_html"),
        F.regexp_count("html", F.lit(r"(?i)<img[\s/>]")).cast("long").alias("image_count"),
        url_segment(F.col("url")).alias("category"),
    )
