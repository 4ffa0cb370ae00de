"""Main text of web pages from streaming parser events.

The standard library's parser gives events; block elements cut the page into lines. A line has its text, the number of tags met
in it, its characters inside links and the block it lies in. Lines inside elements that name themselves as something else
(navigation, footers, forms, adverts, comments ...) go first; a name of a state or layout (``has-sidebar``, ``menu-closed``) names nothing, and
an element that holds all articles of the page, or without those most of its text, isn't believed its name unless that is of readers. Over the others the text-to-tag ratio is smoothed by a Gaussian and
cut at one standard deviation; runs of lines above it are clusters. Content is the region that holds the clusters, with all its lines:
the outermost ``article`` or ``main`` elements with their siblings of that kind, else the closest common section or ``div`` of more
than one line, else the page.

Null and empty pages have the empty text. Unclosed elements and stray end tags are taken as browsers do; nothing is capped.
Repeated rows are extracted again; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.words import map_texts
from alluvia.queries.registry import table

# Kinds of elements, and words in class, id and role that name what an element is.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table
    tbody td tfoot th thead title tr ul""".split())
REGIONS = set("center div section".split())
NOT_CONTENT = set("""aside button datalist dialog footer form head iframe input math menu nav noscript object search script select
    style svg template textarea title""".split())
CLOSES_P = BLOCK - set("body html dd dt li option optgroup caption tbody td tfoot th thead tr title".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "option": {"select", "datalist"}}
P_SCOPE = {"table", "td", "th", "button", "body", "html"}
CONTENT_NAMES = {"article", "main"}
NAMES_OTHER = set("""ad ads adbox adslot advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment
    commentlist comments consent cookie cookies disclaimer discussion disqus footer gdpr headerbar legal login masthead menu menubar
    modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo promotion recommended related
    reply replies responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud teaser
    toolbar topbar widget widgets""".split())
ROLES_OTHER = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search toolbar".split())
PAGE_HEADER = {"header"}

#: Words that make a name say how a page is set up or what state it is in, not what the element is.
STATES = set("""has have with without no not open opened closed free enabled disabled on off active inactive collapsed expanded visible
    layout template theme""".split())
READERS = set("comment commentlist comments discussion disqus replies reply responses".split())

_TOKEN = re.compile("[a-z]+")


def other_names(value: str) -> set[str]:
    """The words of a class or id that name an element as something else; a name like ``has-sidebar`` or ``menu-closed`` has none."""
    found: set[str] = set()
    for name in value.lower().split():
        words = _TOKEN.findall(name)
        if not STATES.intersection(words):
            found.update(words)
    return found


class Line:
    __slots__ = ("parts", "tags", "linked", "block")

    def __init__(self, block: int):
        self.parts: list[tuple[int, str]] = []  # the innermost named element that a piece of text is in, and the piece
        self.tags = 0
        self.linked = 0
        self.block = block


class PageLines(HTMLParser):
    """Collects the lines of a page. Elements are numbered as they open and know their parent, so nesting costs nothing.

    What lies in elements of other kinds (navigation, forms, scripts ...) or hidden ones is dropped at once. Elements that are merely
    *named* as something else are judged at the end of the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, int, int]] = []  # tag, number, whether it hides, the block and the named element before
        self.open: Counter[str] = Counter()
        self.hidden = 0
        self.links = 0
        self.held = 0  # articles and mains that are open
        self.block = 0  # the innermost open block, 0 is the page
        self.named = 0  # the innermost open named element
        self.parent = [0]  # of each block: the block around it
        self.kinds = [""]
        self.surroundings: list[int | None] = [None]  # of each element: what is around the outermost article or main that it lies in
        self.named_in: dict[int, int] = {0: 0}  # of each named element: the named element around it
        self.is_readers: set[int] = set()
        self.regions: list[int] = []  # of each article or main that is none of these itself: the named element it lies in
        self.lines: list[Line] = []
        self.line = Line(0)

    def updatepos(self, i, j):  # line numbers are not needed
        return j

    def _break(self) -> None:
        if self.line.parts:
            self.lines.append(self.line)
        self.line = Line(self.block)

    def _judged(self, tag: str, attrs) -> tuple[bool, set[str]]:
        """Whether an element hides its content for certain, and the names it has of something else."""
        if tag in NOT_CONTENT:
            return True, set()
        if tag in ("html", "body"):
            return False, set()
        if tag == "header":
            return not self.held, set()
        named: set[str] = set()
        for key, value in attrs:
            if key in ("hidden", "aria-modal") or key == "aria-hidden" and value == "true":
                return True, set()
            if not value:
                continue
            if key in ("class", "id"):
                named |= other_names(value)
            elif key == "role" and value.strip().lower() in ROLES_OTHER:
                return True, set()
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                return True, set()
        return False, named & (NAMES_OTHER if self.held else NAMES_OTHER | PAGE_HEADER)

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, _, hides, self.block, self.named = self.stack.pop()
            self.open[tag] -= 1
            self.hidden -= hides
            self.links -= tag == "a"
            self.held -= tag in CONTENT_NAMES

    def _close(self, tags: set[str], scope: set[str]) -> None:
        if not any(self.open[t] for t in tags):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                return self._pop(k)
            if self.stack[k][0] in scope:
                return None

    def _born(self, tag: str, attrs) -> None:
        hides, names = self._judged(tag, attrs)
        number = len(self.kinds)
        self.stack.append((tag, number, hides, self.block, self.named))
        self.open[tag] += 1
        self.hidden += hides
        self.links += tag == "a"
        self.kinds.append(tag)
        self.parent.append(self.block)
        around = self.surroundings[self.block]
        self.surroundings.append(self.block if around is None and tag in CONTENT_NAMES else around)
        if names:
            self.named_in[number] = self.named
            self.named = number
            if names & READERS:
                self.is_readers.add(number)
        elif tag in CONTENT_NAMES and not self.hidden:
            self.regions.append(self.named)
        self.held += tag in CONTENT_NAMES
        if tag in BLOCK:
            self.block = number

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            if tag in CLOSES_P:
                self._close({"p"}, P_SCOPE)
            if tag in SIBLINGS:
                self._close(SIBLINGS[tag], SCOPES[tag])
        if tag not in VOID:
            self._born(tag, attrs)
        if tag in BLOCK:
            self._break()
        elif tag == "br" and not self.hidden and self.line.parts:
            self.line.parts.append((self.named, " "))
        self.line.tags += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open[tag]:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    self._pop(k)
                    break
        self.line.tags += 1
        if tag in BLOCK:
            self._break()

    def handle_data(self, data):
        if not self.hidden:
            self.line.parts.append((self.named, data))
            if self.links:
                self.line.linked += len(data)

    def shown(self) -> set[int]:
        """Named elements whose content counts all the same (0: outside of all).

        Such are those that hold every ``article`` and ``main`` of the page or, when it has none, most of its text; never those of readers.
        """
        text, articles = Counter(), Counter(self.regions)
        for line in self.lines:
            for named, piece in line.parts:
                text[named] += len(piece.split())
        most = sum(text.values()) / 2
        for e in sorted(self.named_in, reverse=True):  # inner elements come after the ones around them
            if e:
                text[self.named_in[e]] += text[e]
                articles[self.named_in[e]] += articles[e]
        shown = {0}
        for e in sorted(self.named_in):
            if e and self.named_in[e] in shown and e not in self.is_readers:
                if articles[e] == len(self.regions) if self.regions else text[e] > most:
                    shown.add(e)
        return shown


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing; at the edges over the lines that exist."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach:reach + len(ratios)] / weight


def main_text(html: str | None) -> str:
    """The article of one page."""
    if not html:
        return ""
    parser = PageLines()
    parser.feed(html)
    parser.close()
    parser._break()
    shown = parser.shown()
    lines = [(x, t) for x in parser.lines if (t := " ".join("".join(piece for named, piece in x.parts if named in shown).split()))]
    if not lines:
        return ""
    ratios = smoothed(np.array([len(t) / max(1, x.tags) for x, t in lines]))
    dense = np.flatnonzero(ratios >= min(ratios.std(), ratios.max()))
    # Each line's outermost article or main, named by what surrounds it.
    around = [parser.surroundings[x.block] for x, _ in lines]
    chosen = {around[k] for k in dense} - {None}
    if chosen:
        return " ".join(t for (_, t), own in zip(lines, around, strict=True) if own in chosen)
    # Lines and dense lines of each element with all inside: elements come after the ones around them.
    held, held_dense = [0] * len(parser.kinds), [0] * len(parser.kinds)
    for x, _ in lines:
        held[x.block] += 1
    for k in dense:
        held_dense[lines[k][0].block] += 1
    for n in range(len(held) - 1, 0, -1):
        held[parser.parent[n]] += held[n]
        held_dense[parser.parent[n]] += held_dense[n]
    region = next((n for n in range(len(held) - 1, 0, -1)
                   if held_dense[n] == len(dense) and held[n] > 1 and parser.kinds[n] in REGIONS), 0)
    inside = [region == 0] * len(held)
    for n in range(1, len(held)):
        inside[n] = n == region or inside[parser.parent[n]]
    return " ".join(t for x, t in lines if inside[x.block])


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None, into: str = "content") -> DataFrame:
    """The columns ``keep`` and a struct ``into`` that holds the main ``text``."""
    def compute(texts):
        return [pa.array([main_text(t) for t in texts], pa.string())]

    return map_texts(pages, html, compute, [T.StructField("text", T.StringType())], into, keep)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return rows.select("page_id", "url", "content.text", F.length("content.text").cast("long").alias("n_chars"))
