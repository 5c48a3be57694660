"""The main text of HTML pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clusters.

The standard library's parser streams events; block elements cut the page into lines, each with its text, its tags, the
part of it inside links, and the elements it lies in. Text in menus, forms and the like never counts. An element whose class
or id only names a surrounding is a mark on its text: the text counts if the element holds most of the page's dense text or
its only article. The text-to-tag ratio of every line is smoothed along the page; lines above a threshold form the clusters that hold the
article. If most of their text lies in article elements, all articles with such text are the region, or else main elements
in the same way; if in neither, the innermost element that holds nearly all of it. All blocks of the region are the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import columns, small_batches

SMOOTHING = 1.5  # standard deviation of the smoothing, in lines
THRESHOLD = 0.5  # of the mean smoothed ratio
LINKED = 0.6  # a line with a larger part of its text inside links is a list of links
HELD = 0.8  # part of the clusters' text that their region holds
MOST = 0.5  # an element with a larger part of the page's dense text is no surrounding; articles with it are the region

# HTML's elements by kind, and the words by which pages name what surrounds an article.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
SILENT = set(
    "head script style noscript template nav aside footer form iframe object svg math canvas audio video button select "
    "textarea dialog menu".split()
)
BLOCKS = set(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr blockquote "
    "pre figure figcaption header hr address details summary fieldset center hgroup search".split()
) | SILENT
REGIONS = set("body article main section div td blockquote".split())
CELLS = {"td", "th", "br"}
CLOSES_P = BLOCKS - {"html", "body"} - {"script", "style", "noscript", "template", "head"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
COMMENTS = set("comment comments commentlist reply replies respond disqus discussion".split())
SURROUNDINGS = COMMENTS | set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended recommendations widget toolbar pagination "
    "pager copyright disclaimer alert skip".split()
)
# The element that a start tag ends, and the elements beyond which that one stays open.
ENDS = {
    "li": ("li", {"ul", "ol", "menu"}), "tr": ("tr", {"table"}), "td": ("td", {"tr", "table"}), "th": ("th", {"tr", "table"}),
    "dt": ("dd", {"dl"}), "dd": ("dt", {"dl"}), "body": ("head", set()),
}
NAMES = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


UNCLOSED = re.compile(r"<!--[^>]*>?")


class Line:
    __slots__ = ("inside", "linked", "parts", "tags", "text")

    def __init__(self, inside: tuple[int, ...]):
        self.parts: list[tuple[str, tuple[int, ...], int]] = []  # text, the marks on it, how much of it is inside links
        self.tags, self.linked, self.inside, self.text = 0, 0, inside, ""


class PageLines(HTMLParser):
    """Collects the lines of one page; `regions` gives the element name of each region, `marks` whether a mark is one of
    comments, and `homes` the marks around each article or main element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, int]] = []  # element, its region or 0, whether it silences, its mark or 0
        self.regions: dict[int, str] = {}
        self.lines: list[Line] = []
        self.line = Line(())
        self.inside: tuple[int, ...] = ()
        self.marked: tuple[int, ...] = ()
        self.marks: dict[int, bool] = {}
        self.homes: dict[int, tuple[int, ...]] = {}
        self.silent = self.links = self.articles = self.paragraphs = self.made = 0

    def _next_line(self) -> None:
        line = self.line
        if line.parts:
            if any(text.strip() for text, _, _ in line.parts):
                self.lines.append(line)
                self.line = Line(self.inside)
                return
            line.parts.clear()
        line.inside = self.inside

    def _surrounds(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in ("html", "body"):
            return False
        if tag in SILENT or tag == "header" and not self.articles:
            return True
        given = {name: (value or "").lower() for name, value in attrs}
        if "hidden" in given or given.get("aria-hidden") == "true" or HIDDEN.search(given.get("style", "")):
            return True
        return tag not in ("article", "main") and given.get("role") in ROLES

    @staticmethod
    def _named(tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
        """The words of a class or id that name a surrounding."""
        given = {name: (value or "").lower() for name, value in attrs}
        names = set(NAMES.findall(f"{given.get('class', '')} {given.get('id', '')}"))
        if tag in ("html", "body"):
            return set()
        article = tag in ("article", "main") or given.get("role") in ("main", "article")
        return names & (COMMENTS if article else SURROUNDINGS)

    def _pop(self, depth: int) -> None:
        for tag, region, silences, mark in self.open[depth:]:
            self.silent -= silences
            if mark:
                self.marked = self.marked[:-1]
            self.links -= tag == "a"
            self.paragraphs -= tag == "p"
            self.articles -= tag in ("article", "main")
            if region:
                self.inside = self.inside[:-1]
        del self.open[depth:]

    def _close_open(self, tag: str) -> None:
        """Elements whose end a new `tag` implies."""
        ends = [("p", {"table", "button"})] if tag in CLOSES_P and self.paragraphs else []
        ends += [ENDS[tag]] if tag in ENDS else []
        for end, within in ends:
            for depth in range(len(self.open) - 1, -1, -1):
                name = self.open[depth][0]
                if name == end:
                    self._pop(depth)
                    break
                if name in within:
                    break

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block or tag in ENDS:
            self._close_open(tag)
        if block:
            self._next_line()
        elif tag in CELLS:
            self.line.parts.append((" ", self.marked, 0))
        self.line.tags += 1
        if tag in VOID:
            return
        if self.silent and tag in ("article", "main"):  # no menu holds one: it was not closed
            menu = next((depth for depth, (name, *_) in enumerate(self.open) if name == "nav"), None)
            if menu is not None:
                self._pop(menu)
                self._next_line()
        silences = bool(attrs or tag in SILENT or tag == "header") and self._surrounds(tag, attrs)
        named = self._named(tag, attrs) if attrs and not silences else None
        mark = region = 0
        if named:
            mark = len(self.marks) + 1
            self.marks[mark] = bool(named & COMMENTS)
            self.marked = (*self.marked, mark)
        if tag in REGIONS:
            self.made += 1
            region = self.made
            self.regions[region] = "main" if ("role", "main") in attrs or ("role", "article") in attrs else tag
            self.inside = (*self.inside, region)
            if self.regions[region] in ("article", "main"):
                self.homes[region] = self.marked
        self.open.append((tag, region, silences, mark))
        self.silent += silences
        self.links += tag == "a"
        self.paragraphs += tag == "p"
        self.articles += tag in ("article", "main")
        if block:
            self.line.inside = self.inside

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                break
        else:
            return
        if tag in BLOCKS or any(t in BLOCKS for t, *_ in self.open[depth:]):
            self._next_line()
        self.line.tags += 1
        self._pop(depth)
        self.line.inside = self.inside

    def handle_data(self, data):
        if not self.silent:
            self.line.parts.append((data, self.marked, len(data.strip()) if self.links else 0))

    def updatepos(self, i, j):
        return j  # no one asks for line numbers

    def parse_marked_section(self, i, report=1):
        """A marked section of a kind that the parser does not know ends with its first `>`."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or -1

    def finish(self) -> list[Line]:
        """The lines; comments that nothing closes end with their first `>`, and the page goes on after it."""
        if self.rawdata.startswith("<!--"):
            rest, self.rawdata = UNCLOSED.sub("", self.rawdata), ""
            self.feed(rest)
        self.close()
        self._next_line()
        return self.lines


def smoothed(ratios: np.ndarray, deviation: float) -> np.ndarray:
    """A Gaussian average along the lines; weights beyond either end of the page are left out."""
    reach = max(1, math.ceil(3 * deviation))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / deviation) ** 2)
    cut = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[cut] / np.convolve(np.ones(len(ratios)), kernel)[cut]


def readable(lines: list[Line], without: set[int]) -> list[Line]:
    """The lines that have text beside that of the marks `without`; the tags of the others count for the next one."""
    found, tags = [], 0
    for line in lines:
        tags += line.tags
        parts = [p for p in line.parts if not without.intersection(p[1])] if without else line.parts
        text = " ".join("".join(p[0] for p in parts).split())
        if text:
            one = Line(line.inside)
            one.parts, one.text, one.tags, one.linked = parts, text, tags, sum(p[2] for p in parts)
            found.append(one)
            tags = 0
    return found


def clusters(lines: list[Line]) -> tuple[np.ndarray, np.ndarray]:
    """The size of each line and whether it lies in a dense cluster."""
    size = np.array([len(line.text) for line in lines], dtype=float)
    linked = np.array([min(1.0, line.linked / len(line.text)) for line in lines])
    ratio = size * (1 - linked) / np.array([max(line.tags, 1) for line in lines])
    smooth = smoothed(ratio, SMOOTHING)
    return size, (smooth >= THRESHOLD * smooth.mean()) & (linked <= LINKED)


def surroundings(page: PageLines, lines: list[Line]) -> set[int]:
    """The marks whose text does not count. An element that holds most of the dense text is none of them, nor is one that
    holds the only articles and more of that text than lies outside all marks or in any other mark. Comments follow what they are about: an
    element named so is released if no article lies outside all marks and it holds the first dense text and most of it.
    Beside an article outside all marks, an element needs as many dense lines, and outside of that nearly all dense text."""
    size, dense = clusters(lines)
    weights: list[tuple[frozenset[int], float]] = []
    articles: set[int] = set()
    for line, weight in zip(lines, np.where(dense, size, 0), strict=True):
        if weight:
            articles.update(r for r in line.inside if r in page.homes)
            lengths = [len(text.strip()) for text, _, _ in line.parts]
            weights += [(frozenset(p[1]), weight * n / sum(lengths)) for p, n in zip(line.parts, lengths, strict=True) if n]
    free = any(not page.homes[r] for r in articles)

    def held(mark: int, without: int = 0) -> float:
        return sum(w for marks, w in weights if mark in marks and without not in marks)

    total = sum(w for _, w in weights)
    comments = {m for m, named in page.marks.items() if named}
    if not free and weights:
        comments = {m for m in comments if m not in weights[0][0] or held(m) <= MOST * total}
    weights = [(marks, w) for marks, w in weights if not marks & comments]
    total, bare = sum(w for _, w in weights), sum(w for marks, w in weights if not marks)
    around = set() if free else {m for r in articles for m in page.homes[r]}
    named = page.marks.keys() - comments
    least = {m: max([bare, *(held(other, m) for other in named)]) if m in around else MOST * total for m in named}
    if free:
        own = [{m for _, marks, _ in line.parts for m in marks} for line in lines]
        of_article = [any(r in page.homes and not page.homes[r] for r in line.inside) for line in lines]
        for m in named:
            mine = [i for i in np.flatnonzero(dense) if m in own[i]]
            others = sum(of_article[i] and m not in own[i] for i in np.flatnonzero(dense))
            if len(mine) < others:
                least[m] = total
            elif not all(of_article[i] for i in mine):
                least[m] = HELD * total
    return comments | {m for m in named if held(m) <= least[m]}


def main_blocks(html: str | None) -> list[str]:
    page = PageLines()
    page.feed(html or "")
    lines = readable(page.finish(), set())
    if lines and page.marks:
        lines = readable(page.lines, surroundings(page, lines))
    if not lines:
        return []
    size, dense = clusters(lines)
    held: Counter[int] = Counter()
    for line, weight in zip(lines, np.where(dense, size, 0), strict=True):
        for region in set(line.inside):
            held[region] += weight
    total = size[dense].sum()
    if not total:
        return []
    for tag in ("article", "main"):
        chosen = {region for region, name in page.regions.items() if name == tag and held[region] > 0}
        kept = [i for i, line in enumerate(lines) if chosen.intersection(line.inside)]
        if chosen and size[kept][dense[kept]].sum() >= MOST * total:
            return [lines[i].text for i in kept]
    around = [region for region, weight in held.items() if weight >= HELD * total]
    return [line.text for line in lines if not around or max(around) in line.inside]


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the blocks of the article of every page, joined by an empty line.

    A null or empty page, and one without an article, gives the empty text. Pages without an id or address are extracted
    like others, repeated rows give repeated results, an empty table gives no rows. Broken markup is read as far as the
    parser gets: unknown marked sections and comments that nothing closes end with their first `>`, a menu that is not closed
    before the article ends there, anything else that is not closed ends with the page.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in small_batches(iter([batch]), 500):
                texts = ["\n\n".join(main_blocks(html)) for html in columns(rows, "html")[0]]
                kept = {"page_id": rows.column("page_id"), "url": rows.column("url"), "text": pa.array(texts, pa.string())}
                yield pa.RecordBatch.from_pydict(kept | {"n_chars": pa.array([len(t) for t in texts], pa.int64())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
