"""Main text of web pages by text-to-tag ratios (operator 11).

A page's markup runs once through the standard library's event parser.  Its
events are folded into *lines*, one for each block of text, which remember
their number of tags, their element and what surrounds it; no tree of the
page is kept beyond the parents of its block elements.

1. Each line's text-to-tag ratio is its characters divided by its tags (one
   at least).  Lines of scripts, styles and the like do not count.
2. The ratios are smoothed along the page by a Gaussian, and those that reach
   one standard deviation are clustered as content.
3. The content lines select the page's regions: the outermost ``article``
   elements that hold any, else ``main``, else the smallest element that holds
   most of their characters.
4. Every line of a region belongs to the text, short ones too, except those
   inside menus, headers, footers, sidebars, notices, adverts, forms and
   reader comments, told by element, role or name.

A name is only a hint: an element so named that holds the page's heading or
article (``<div class="with-sidebar">`` around everything) is no boilerplate.

White space is what ``str.split`` splits at; ``br`` and replaced elements count
as white space; a table cell is a block.

Defined cases: null and empty pages, and pages without text, give the empty
text; unclosed and misplaced tags are taken as browsers do (a new block ends an
open paragraph, an end tag without its start is ignored); without a line that
reaches the threshold all lines take part in the choice of a region; equal
rows get equal results; an empty table gives an empty result; further columns
are passed through if asked for, whatever their names, and not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Standard deviation of the smoothing in lines, and standard deviations of the ratios that content reaches.
SIGMA, REACH = 1.0, 1.0
#: Share of the content's characters that an element must hold to be the region.
MOST = 0.7

# Elements and names of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
SPACE = frozenset("br img input embed wbr".split())
SILENT = frozenset("head script style noscript template iframe object svg math canvas audio video map datalist title".split())
BOILERPLATE = frozenset("nav footer aside menu dialog search button select textarea".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog menu menubar navigation note search status tablist toolbar".split()
)
HEADERS = frozenset("banner header masthead topbar".split())
NAMES = HEADERS | frozenset(
    "ad ads advert advertisement advertising adverts aside breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer form gdpr login menu modal nav navbar navigation newsletter notice notices notification notifications overlay pager "
    "pagination popup promo related respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar widget".split()
)
ENDS = {  # a start tag ends an open element of these kinds
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
    "tbody": {"td", "th", "tr", "thead", "tbody"}, "tfoot": {"td", "th", "tr", "tbody"},
}
#: Elements inside which an outer paragraph stays open.
SCOPES = frozenset("button caption object table td th template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TOKENS = re.compile(r"[a-z0-9]+")


@dataclass
class Element:
    """A block element: its place among the page's elements is its number."""

    tag: str
    parent: int
    silent: bool = False  # inside scripts and the like
    hard: bool = False  # boilerplate by element or role
    names: frozenset = frozenset()  # boilerplate by these names, unless it holds the article
    heading: bool = False  # holds a first-level heading
    holds: bool = False  # holds an article or main element


@dataclass
class Line:
    element: int
    tags: int = 0
    links: int = 0  # characters inside links
    parts: list[str] = field(default_factory=list)
    text: str = ""


def hints(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, frozenset]:
    """Whether an element is boilerplate, and the names that suggest it."""
    hard, names = tag in BOILERPLATE, set()
    for key, value in attrs:
        if not value:
            continue
        if key == "role":
            hard = hard or value.strip().lower() in ROLES
        elif key in ("class", "id") and tag not in ("html", "body", "main"):
            # an article's classes often tag its subject, so only whole names count there
            low = value.lower()
            names.update(NAMES.intersection(low.split() if tag == "article" else _TOKENS.findall(low)))
    if tag in ("form", "fieldset"):
        names.add("form")
    if tag == "header":
        names.add("header")
    return hard, frozenset(names)


class Lines(HTMLParser):
    """Folds the events of a page into ``elements`` and ``lines``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", -1)]
        self.open = [0]
        self.count: dict[str, int] = {}
        self.paragraphs: list[int | None] = [None]  # depth of the open paragraph in each scope
        self.in_link = 0
        self.lines: list[Line] = []
        self.line = Line(0)

    def start_line(self) -> None:
        if self.line.parts:
            self.line.text = " ".join("".join(self.line.parts).split())
            if self.line.text:
                self.lines.append(self.line)
        self.line = Line(self.open[-1])

    def close_to(self, depth: int) -> None:
        """Ends all open elements beyond ``depth`` of them."""
        while len(self.open) > depth:
            tag = self.elements[self.open.pop()].tag
            self.count[tag] -= 1
            if tag in SCOPES:
                self.paragraphs.pop()
            elif tag == "p":
                self.paragraphs[-1] = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            self.in_link += 1
        if tag in SPACE:
            self.line.parts.append(" ")
        block = tag in BLOCK
        if block:
            if tag == "p" or tag not in SCOPES and tag not in ENDS:
                if self.paragraphs[-1] is not None:
                    self.close_to(self.paragraphs[-1])
            while len(self.open) > 1 and self.elements[self.open[-1]].tag in ENDS.get(tag, ()):
                self.close_to(len(self.open) - 1)
        if tag not in VOID:
            hard, names = hints(tag, attrs)
            if block or hard or names or tag in SILENT or tag in SCOPES:
                above = self.elements[self.open[-1]]
                self.elements.append(Element(tag, self.open[-1], above.silent or tag in SILENT, hard, names))
                self.open.append(len(self.elements) - 1)
                self.count[tag] = self.count.get(tag, 0) + 1
                if tag in SCOPES:
                    self.paragraphs.append(None)
                elif tag == "p":
                    self.paragraphs[-1] = len(self.open) - 1
                if not self.elements[-1].silent:
                    self.mark(tag, names)
        if block:
            self.start_line()
        elif self.line.element != self.open[-1]:
            self.start_line()
        self.line.tags += 1

    def mark(self, tag: str, names: frozenset) -> None:
        """Tells the open elements that they hold a heading or an article."""
        if tag == "h1":
            for i in reversed(self.open):
                if self.elements[i].heading:
                    break
                self.elements[i].heading = True
        elif tag == "main" or tag == "article" and not names:
            for depth in range(len(self.open) - 2, -1, -1):
                if self.elements[self.open[depth]].holds:
                    break
                self.elements[self.open[depth]].holds = True

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if self.count.get(tag):
            depth = len(self.open) - 1
            while self.elements[self.open[depth]].tag != tag:
                depth -= 1
            self.close_to(depth)
        self.line.tags += 1
        if tag in BLOCK or self.line.element != self.open[-1]:
            self.start_line()

    def handle_data(self, data: str) -> None:
        if self.elements[self.open[-1]].silent:
            return
        self.line.parts.append(data)
        if self.in_link:
            self.line.links += len(data)

    # The whole page is there, so what is not ended by now never will be: a
    # comment or tag without an end swallows the rest, as in browsers.
    def settled(self, i: int, k: int) -> int:
        if k >= 0:
            return k
        end = self.rawdata.find(">", i)
        return len(self.rawdata) if end < 0 else end + 1

    def parse_comment(self, i: int, report: bool = True) -> int:
        k = super().parse_comment(i, report)
        return len(self.rawdata) if k < 0 else k

    def parse_starttag(self, i: int) -> int:
        return self.settled(i, super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self.settled(i, super().parse_endtag(i))

    def parse_pi(self, i: int) -> int:
        return self.settled(i, super().parse_pi(i))

    def parse_html_declaration(self, i: int) -> int:
        bogus = self.rawdata.startswith("<![", i)
        return self.settled(i, self.parse_bogus_comment(i) if bogus else super().parse_html_declaration(i))

    def finish(self) -> list[Line]:
        self.close()
        self.start_line()
        return self.lines


def boilerplate(elements: list[Element], lines: list[Line]) -> np.ndarray:
    """Which lines lie inside boilerplate."""
    dropped = np.zeros(len(elements), bool)
    in_article = np.zeros(len(elements), bool)
    header = np.zeros(len(elements), bool)  # an article's own header, of which headings stay
    for i, e in enumerate(elements):
        if e.parent >= 0:
            dropped[i], in_article[i], header[i] = dropped[e.parent], in_article[e.parent], header[e.parent]
        if e.tag == "header" and in_article[i]:
            header[i] = True
        elif e.hard or e.names and not (e.holds or e.heading and not e.names & HEADERS):
            dropped[i] = True
        in_article[i] |= e.tag in ("article", "main") and not dropped[i]
    return np.array([dropped[x.element] or header[x.element] and elements[x.element].tag not in HEADINGS for x in lines], bool)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean of neighbouring ratios; at the ends of what is there."""
    radius = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weights


def regions(elements: list[Element], lines: list[Line], content: np.ndarray) -> set[int]:
    """Elements that hold the content lines."""
    weight = np.zeros(len(elements), np.int64)
    for i in np.flatnonzero(content):
        weight[lines[i].element] += len(lines[i].text)
    inside = np.full(len(elements), -1)  # outermost article or main around each element
    for i, e in enumerate(elements):
        if e.parent >= 0:
            inside[i] = inside[e.parent]
        if inside[i] < 0 and e.tag == "article":
            inside[i] = i
    for i in range(len(elements) - 1, 0, -1):  # children come after their parents
        weight[elements[i].parent] += weight[i]
    articles = {int(i) for i in np.flatnonzero(weight > 0) if inside[i] == i}
    mains = {i for i, e in enumerate(elements) if e.tag == "main" and weight[i] > 0}
    if articles or mains:
        return articles or mains
    best = 0  # an element's only child with most of the weight comes after it
    for i in range(1, len(elements)):
        if elements[i].parent == best and weight[i] >= MOST * weight[0] and elements[i].tag not in HEADINGS | {"p", "li"}:
            best = i
    return {best}


def main_text(html: str) -> str:
    """Blocks of the article, joined by line feeds."""
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    elements = parser.elements
    dropped = boilerplate(elements, lines)
    ratios = np.array([len(x.text) / max(1, x.tags) for x in lines])
    level = smoothed(ratios)
    content = (level >= REACH * level.std()) & ~dropped
    if not content.any():
        content = ~dropped
    chosen = regions(elements, lines, content)
    within = np.zeros(len(elements), bool)
    for i, e in enumerate(elements):
        within[i] = i in chosen or e.parent >= 0 and within[e.parent]
    keep = ~dropped & np.array([within[x.element] for x in lines])
    if not any(elements[i].tag in ("article", "main") for i in chosen):
        keep &= ~link_lists(elements, lines, content)
    return "\n".join(x.text for x, k in zip(lines, keep, strict=True) if k)


def link_lists(elements: list[Element], lines: list[Line], content: np.ndarray) -> np.ndarray:
    """Lines in elements that are mostly links and hold no content line, for
    pages that name neither their article nor their menus."""
    size, links, held = (np.zeros(len(elements), np.int64) for _ in range(3))
    for line, found in zip(lines, content, strict=True):
        size[line.element] += len(line.text)
        links[line.element] += line.links
        held[line.element] += found and line.links * 2 <= len(line.text)
    for i in range(len(elements) - 1, 0, -1):
        for x in (size, links, held):
            x[elements[i].parent] += x[i]
    menu = np.zeros(len(elements), bool)
    for i, e in enumerate(elements):
        own = e.tag in ("ul", "ol", "div", "section", "table", "dl") and links[i] * 2 > size[i] and not held[i]
        menu[i] = own or e.parent >= 0 and menu[e.parent]
    return np.array([menu[x.element] for x in lines], bool)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], names=["row", "text"])


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, by default all but the
    markup), ``text`` and ``n_chars`` of every page."""
    names = [c for c in pages.columns if c != html_col] if keep is None else keep
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{html_col}`").alias("html"))
    schema = StructType().add(packed.schema["row"]).add("text", "string")
    return packed.mapInArrow(_texts, schema).withColumn("n_chars", F.length("text").cast("long"))
