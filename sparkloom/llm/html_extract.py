"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags, in time linear in its length. Each block has its word count and link
density, those of the blocks before and after it, whether it ends as a sentence does, and where it stands: in an article,
beside one, in a heading, in an element named for content. An element whose tag or name speaks of menus, notices, adverts
or comments is no verdict: the block has that element's share of the page's words, and what holds most of a page can't be
that. The tree is grown when the module is first used, from the blocks of the pages in ``labelled_pages``.

Defined results: a null or empty html gives an empty text; unclosed and crossed tags, truncated pages and bare text are
read as far as they go; repeated rows are treated alike; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import spread
from sparkloom.llm.labelled_pages import PAGES

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PIECE = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
#: Names with one of these say how an element is or what it lacks, not what it is.
STATES = set("no not has have with without is ready enabled disabled active inactive open closed on off target".split())
#: Elements whose content isn't text of the page.
OPAQUE = {"script", "style", "head", "title", "noscript", "template", "svg", "iframe", "object", "canvas", "audio", "video", "math", "textarea", "select", "datalist"}
RAW = {"script", "style", "title", "textarea", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
BOILER_TAGS = {"nav", "footer", "aside", "form", "menu", "button", "dialog", "fieldset"}
BOILER_WORDS = set(
    "ad ads adbox advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright disclaimer disqus footer form gdpr "
    "header infobar login masthead menu menubar modal nav navbar navigation navigationbar newsletter notice notices notification overlay pager pagination paywall popup privacy promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription syndication tags teaser toolbar topbar trending warning widget widgets alert complementary contentinfo dialog".split()
)
CONTENT_WORDS = set("article articlebody body content entry main post story text".split())
SECTIONS = {"article", "main"}


class Block(NamedTuple):
    text: str
    words: int
    density: float
    article: bool
    content: bool
    heading: bool
    #: Number of the innermost element around it that speaks of boilerplate; -1: none.
    mark: int


class Open(NamedTuple):
    """An open element, with what is around it."""

    name: str
    article: bool = False
    content: bool = False
    mark: int = -1


class Page(NamedTuple):
    blocks: list[Block]
    #: Words in each element that speaks of boilerplate.
    marked: list[int]


class _Reader:
    """Open elements with the places of each name, so that no tag looks through all of them."""

    def __init__(self) -> None:
        self.stack: list[Open] = []
        self.places: dict[str, list[int]] = {}
        self.opaque: list[int] = []
        self.headings = 0
        #: For each marked element, the one around it and the words within it alone.
        self.around: list[int] = []
        self.own: list[int] = []

    def push(self, element: Open) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        if element.name in OPAQUE:
            self.opaque.append(len(self.stack))
        self.headings += element.name in HEADINGS
        self.stack.append(element)

    def pop(self) -> str:
        name = self.stack.pop().name
        self.places[name].pop()
        if self.opaque and self.opaque[-1] == len(self.stack):
            self.opaque.pop()
        self.headings -= name in HEADINGS
        return name

    def close(self, name: str) -> None:
        places = self.places.get(name)
        if places:
            last = places[-1]
            while len(self.stack) > last:
                self.pop()

    def show_all(self) -> None:
        """Elements whose content isn't text end here."""
        self.opaque.clear()

    def enter(self, name: str, attributes: str) -> None:
        around = self.stack[-1] if self.stack else Open("")
        content, boiler = _names(name, attributes)
        boiler = boiler or name in BOILER_TAGS or (name == "header" and not around.article)
        mark = around.mark
        if boiler:
            self.around.append(mark)
            self.own.append(0)
            mark = len(self.own) - 1
        self.push(Open(name, around.article or name in SECTIONS, around.content or content, mark))

    def words(self) -> list[int]:
        """Words of each marked element, those of the marked elements in it included: inner ones come later."""
        total = list(self.own)
        for k in range(len(total) - 1, -1, -1):
            if self.around[k] >= 0:
                total[self.around[k]] += total[k]
        return total


def read_page(html: str | None) -> Page:
    """Text blocks in page order, and the marked elements around them."""
    source = html or ""
    out: list[Block] = []
    page = _Reader()
    parts: list[str] = []
    links: list[str] = []
    anchors = 0
    at = 0

    def flush() -> None:
        nonlocal parts, links
        words = "".join(parts).split()
        if words:
            around = page.stack[-1] if page.stack else Open("")
            linked = len("".join(links).split())
            out.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), around.article, around.content, page.headings > 0, around.mark))
            if around.mark >= 0:
                page.own[around.mark] += len(words)
        parts, links = [], []

    def say(raw: str) -> None:
        if raw and not page.opaque:
            text = html_lib.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if anchors:
                links.append(text)

    for m in iter(lambda: TOKEN.search(source, at), None):
        say(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), m[1]
        if name in BLOCK and not page.opaque:
            flush()
        if closing:
            page.close(name)
            if name == "a" and anchors:
                anchors -= 1
                links.append(" ")
            continue
        if name in VOID:
            continue
        if name in RAW:
            end = _raw_end(name).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name == "a":
            anchors = 1
            links.append(" ")
        if m[3].rstrip().endswith("/") and name not in BLOCK:
            continue
        if name == "body":  # a head that was never closed ends here
            page.show_all()
        if name in IMPLIED:
            while page.stack and page.stack[-1].name in INLINE | IMPLIED[name]:
                if page.pop() in IMPLIED[name]:
                    break
        if name in BLOCK or name in OPAQUE:
            if anchors and name in SECTIONS | BOILER_TAGS:
                anchors = 0
            page.enter(name, m[3])
    say(source[at:])
    flush()
    return Page(out, page.words())


def blocks_of(html: str | None) -> list[Block]:
    return read_page(html).blocks


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {"b", "i", "em", "strong", "span"}
IMPLIED = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


@lru_cache(maxsize=None)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*>", re.I)


@lru_cache(maxsize=4096)
def _said(value: str) -> tuple[bool, bool]:
    """Whether a class, id or role speaks of content, and of boilerplate."""
    content = boiler = False
    for token in value.split():
        said = set(PIECE.findall(CAMEL.sub(" ", token).lower()))
        if not said & STATES:
            content, boiler = content or bool(said & CONTENT_WORDS), boiler or bool(said & BOILER_WORDS)
    return content, boiler


def _names(name: str, attributes: str) -> tuple[bool, bool]:
    content = boiler = False
    if attributes and name not in ("html", "body"):
        for key, value in ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in ("class", "id", "role"):
                c, b = _said(value.strip("\"'"))
                content, boiler = content or c, boiler or b
            elif key == "hidden" or key == "style" and HIDDEN_STYLE.search(value):
                boiler = True
    return content, boiler


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "sentence", "article", "content", "heading", "outside", "share")


def rows_of(page: Page) -> list[tuple]:
    """Features of each block. share: that of the marked element around it in the page's words; without one it is the page's, 1."""
    total = sum(b.words for b in page.blocks) or 1
    articled = any(b.article and (b.mark < 0 or 2 * page.marked[b.mark] >= total) for b in page.blocks)
    none = Block("", 0, 0.0, False, False, False, -1)
    out = []
    for before, b, after in zip([none, *page.blocks], page.blocks, [*page.blocks[1:], none]):
        share = page.marked[b.mark] / total if b.mark >= 0 else 1.0
        out.append((b.words, b.density, before.words, before.density, after.words, after.density, b.text[-1] in ".!?:\"”…", b.article, b.content, b.heading, articled and not b.article, share))
    return out


class Tree(NamedTuple):
    feature: int = -1
    limit: float = 0.0
    low: "Tree | bool" = False
    high: "Tree | bool" = False


def grow(rows: list[tuple], depth: int = 12) -> Tree | bool:
    """Binary decision tree by Gini impurity; ties go to the first feature and the smallest limit."""
    yes = sum(r[-1] for r in rows)
    if depth == 0 or yes in (0, len(rows)):
        return yes * 2 >= len(rows)

    def impurity(part: list[tuple]) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            limit = (a + b) / 2
            low, high = [r for r in rows if r[f] <= limit], [r for r in rows if r[f] > limit]
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, limit, low, high
    if best is None:
        return yes * 2 >= len(rows)
    _, f, limit, low, high = best
    return Tree(f, limit, grow(low, depth - 1), grow(high, depth - 1))


@lru_cache(maxsize=1)
def labelled() -> list[tuple]:
    """The labelled table: features of the labelled pages' blocks, and whether they are main text."""
    out = []
    for html in PAGES:
        page = read_page(html)
        out.extend((*row, int(b.text[0] == "+")) for row, b in zip(rows_of(page), page.blocks))
    return out


@lru_cache(maxsize=1)
def classifier() -> Tree | bool:
    return grow(labelled())


def decide(tree: Tree | bool, row: tuple) -> bool:
    while isinstance(tree, Tree):
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return tree


def main_text(html: str | None, tree: Tree | bool | None = None) -> str:
    """Text of the blocks that the tree takes for main text, joined by single spaces."""
    tree = classifier() if tree is None else tree
    page = read_page(html)
    return " ".join(b.text for b, row in zip(page.blocks, rows_of(page)) if decide(tree, row))


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars. A map over the scan: no shuffle."""
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = classifier()
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    id_type, url_type = (source.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return spread(source).mapInArrow(run, f"page_id {id_type}, url {url_type}, text string, n_chars long")
