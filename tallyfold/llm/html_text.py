"""Main text of web pages by tag-path ratios.

A page is read into text blocks, each with the path of the elements that hold it, from the root down. Per path,
text length and punctuation are summed and divided by the number of its blocks: running text is
long and punctuated, menus and labels are neither. The two ratios are smoothed over paths that
follow each other on the page, multiplied, and compared with a threshold; the blocks of the paths
above it are content. The element that holds most of that content is taken as the article: its
other blocks, such as headings, belong to it, and content outside of it does not.

Parts that their tag, class, id or role marks as menu, header, footer, sidebar, notice, advert, form,
script, style or reader comments are left out before anything is counted.

Defined cases: null and empty pages, and pages without text, give an empty text. Unclosed tags end where the
HTML standard lets them end; an unclosed comment or script runs to the end of the page. Repeated rows
are read each. A page is one task's work at a time, in time linear in its length.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyfold.llm.words import slices

#: Kinds of elements, as the HTML standard has them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split())
RAW = set("script style noscript template textarea title iframe svg math object xmp noembed noframes".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: An open element of the second kind ends where one of the first begins.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
BARRIERS = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "html", "main", "blockquote"}
#: Parts that are never the article: by tag, and by the words of class, id and role.
NOISE_TAGS = set("nav footer aside form head button select menu dialog input label fieldset search".split())
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs footer header masthead sidebar aside widget related recommended share sharing social "
    "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe signup login form search "
    "comment comments reply replies disqus complementary contentinfo pagination pager toolbar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
REPLIES = {"comment", "comments", "reply", "replies"}
SINGLE = set("p h1 h2 h3 h4 h5 h6 li".split())
NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")

#: Spread of the smoothing, in paths; share of the largest ratio that a path must reach.
SPREAD, THRESHOLD = 1.0, 0.12
#: Share of the content that the article holds at least.
MOST = 0.75
AT_ONCE = 4 << 20


@dataclass(eq=False)
class Element:
    """An open or closed element; ``path`` is the number of its path from the root."""

    tag: str
    path: int
    parent: Element | None
    noise: bool
    in_article: bool = False
    content: int = 0
    chosen: bool = False


@dataclass(eq=False)
class Block:
    """A run of text between block tags."""

    holder: Element
    parts: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _opened(tag: str, rest: str, parent: Element, paths: dict[tuple[int, str], int]) -> Element:
    named = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in NAMED.finditer(rest)} if rest else {}
    words = {w for value in named.values() for w in WORD.findall(value)}
    holds = tag in ("article", "main")
    noise = (
        parent.noise or tag in NOISE_TAGS or (tag == "header" and not parent.in_article)
        or (bool(words & (NOISE_WORDS if not holds else REPLIES)) and tag not in ("body", "html"))
    )
    name = ".".join([tag, *named.get("class", "").split()[:1]])
    path = paths.setdefault((parent.path, name), len(paths) + 1)
    return Element(tag, path, parent, noise, parent.in_article or holds)


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The text blocks outside of parts marked as no article, and the elements in page order."""
    root = Element("", 0, None, False)
    stack, seen, out, block, at = [root], [root], [], None, 0
    paths: dict[tuple[int, str], int] = {}
    open_tags: Counter[str] = Counter()

    def close(tags: set[str], barriers: set[str]) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                open_tags.subtract(e.tag for e in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in barriers:
                return

    def add(text: str) -> None:
        nonlocal block
        if not text or stack[-1].noise:
            return
        if block is None:
            block = Block(stack[-1])
            out.append(block)
        block.parts.append(text)

    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if tag in RAW and not found["end"]:
            if not found["rest"].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                add(" " if tag != "wbr" else "")
            continue
        block = None
        if found["end"]:
            close({tag}, set())
        else:
            if tag in CLOSES_P:
                close({"p"}, BARRIERS)
            for _ in range(2):
                if tag in SIBLINGS:
                    close(SIBLINGS[tag], {"ul", "ol", "dl", "table", "select"})
            if tag not in VOID and not found["rest"].endswith("/"):
                stack.append(_opened(tag, found["rest"], stack[-1], paths))
                seen.append(stack[-1])
                open_tags[tag] += 1
    return out, seen


def content_paths(paths: list[int], texts: list[str]) -> set[int]:
    """The paths whose blocks are running text, by smoothed and multiplied ratios."""
    length, signs, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, text in zip(paths, texts, strict=True):
        length[path] += len(text)
        signs[path] += len(PUNCTUATION.findall(text))
        count[path] += 1
    order = list(count)
    ratios = [(length[p] / count[p], (signs[p] + 0.5) / count[p]) for p in order]
    reach = range(-2, 3)
    weights = [math.exp(-(d / SPREAD) ** 2 / 2) for d in reach]

    def smooth(k: int, i: int) -> float:
        near = [(w, ratios[i + d][k]) for w, d in zip(weights, reach, strict=True) if 0 <= i + d < len(order)]
        # A path keeps at least its own ratio's part; neighbours only lift it.
        return max(ratios[i][k], sum(w * r for w, r in near) / sum(w for w, _ in near))

    fused = {p: math.sqrt(smooth(0, i) * smooth(1, i)) for i, p in enumerate(order)}
    most = max(fused.values())
    return {p for p, value in fused.items() if value >= THRESHOLD * most}


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by a space."""
    all_blocks, elements = blocks(page or "")
    found = [(b.holder, t) for b in all_blocks if (t := b.text())]
    if not found:
        return ""
    chosen = content_paths([h.path for h, _ in found], [t for _, t in found])
    total = 0
    for holder, text in found:
        if holder.path in chosen:
            holder.content += len(text)
            total += len(text)
    # Children come after their parents, so a walk from the end sums each element's content.
    for element in reversed(elements[1:]):
        element.parent.content += element.content
    # Each step down goes to the one child with most of the content, past those that hold one block.
    article = elements[0]
    for element in elements[1:]:
        if element.parent is article and element.content >= MOST * total and element.tag not in SINGLE:
            article = element
    marked = article
    while marked.parent is not None and marked.tag not in ("article", "main"):
        marked = marked.parent
    (marked if marked.parent is not None else article).chosen = True
    for element in elements[1:]:
        element.chosen = element.chosen or element.parent.chosen
    return " ".join(text for holder, text in found if holder.chosen)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2), AT_ONCE):
                rows = batch.slice(part.start, part.stop - part.start)
                texts = [main_text(page.as_py()) for page in rows.column(2)]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), rows.column(1), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", html_column).mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
