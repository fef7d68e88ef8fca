"""Main text of a web page by line-block distribution.

1. Markup is stripped. Block tags end a line, inline tags leave nothing. What stands in elements that hold no
   article text (scripts, forms, menus, page headers and footers, sidebars, and elements whose class, id or role
   says so) gives an empty line for each block: it counts as a gap.
2. Every line has the length of its text, or 0 if most of the text is links. Lengths are summed over a sliding
   window of ``WINDOW`` lines.
3. A candidate is the text up to the next line where the window is empty, the dive point, if it has a surge point: a
   line where the window sum reaches ``SURGE`` characters. The candidate with most text is the article, and others of
   at least ``SHARE`` of it belong to it too (an article is often cut in parts). On a page without a surge point,
   every stretch is a candidate.
4. If the page marks articles (``article`` or ``main``), candidates end at the marks, and gaps inside are taken out
   before the windows are summed, so that an advert does not cut them. Marked text is always a candidate and weighs
   ``ARTICLE_WEIGHT`` times as much, without lines of links; if it weighs most, all of it stays. Text outside must
   surge to compete with it: so a body in a ``div`` wins over teaser cards that are marked.

Character references are decoded, white space in a line becomes one space, lines are joined by one space.

Names that mark boilerplate also stand on wrappers of whole pages. So the names of page builders and states
(``WRAPPER_WORDS``, forms) are not believed around over half of the page's text, no name is believed if without it
nothing surges, and ``article`` and ``main`` inside such a wrapper stand for themselves.

Defined cases: null or empty html, and pages without text, give the empty text; an empty table gives no rows. Tags that
are never closed end with their parent; an unclosed boilerplate element does not swallow the rest of the page, but
scripts and styles do, and a tag that is cut off ends it. A page is read whole, in time that grows with its length
only, also if it is cut anywhere. Further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logilake.llm.common import query, table

WINDOW = 3
SURGE = 80
SHARE = 0.3
ARTICLE_WEIGHT = 3
LINK_SHARE = 0.6
MOST_NAMES = 16  # named elements inside so many others share their fate

# HTML elements by their role.
RAW_ELEMENTS = "script style template noscript textarea title iframe object svg math canvas select audio video".split()
VOID_ELEMENTS = set("area base br col embed hr img input link meta param source track wbr".split())
UNPARSED_ELEMENTS = {"script", "style"}  # unclosed, they run to the page's end; the others to their parent's
BOILERPLATE_ELEMENTS = set("nav header footer aside form button dialog menu head label fieldset".split())
INLINE_ELEMENTS = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ARTICLE_ELEMENTS = {"article", "main"}
# Words of class, id and role that mark what is no article text.
BOILERPLATE_WORDS = set(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion popup modal overlay "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget related recommended "
    "footer header masthead topbar toolbar cookie cookies consent gdpr notice notices alert disclaimer "
    "comment comments commentlist disqus reply replies respond reviews share sharing social newsletter subscribe "
    "signup login search form pagination pager complementary contentinfo navigation tags byline copyright".split()
)
# Of these words, those that page builders and states of a page also put on wrappers of everything.
WRAPPER_WORDS = set(
    "ad ads modal overlay popup nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar widget header masthead "
    "topbar toolbar share sharing social signup login search form pagination pager tags byline".split()
)
# After these, such a word only tells how the page is laid out ("has-sidebar", "no-ads").
LAYOUT_WORDS = set("has no with without".split())

# Quotes matter after an equals sign only, as in browsers. Possessive, so that a tag without an end is read once.
_TAG = re.compile(
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
)
_TAG_START = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_END_OF = {name: re.compile(rf"</{name}\b[^>]*+>", re.IGNORECASE) for name in RAW_ELEMENTS}
_WORD = re.compile(r"[a-z]+")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none")


class Line(NamedTuple):
    text: str
    links: int  # characters of the text inside links
    article: int  # number of the article element it stands in, 0 outside
    boilerplate: bool

    @property
    def prose(self) -> int:
        """Characters of text, 0 if most of it is links."""
        return 0 if self.links > LINK_SHARE * len(self.text) else len(self.text)


class _Raw(NamedTuple):
    """A line with the numbers of the named elements around it, which are believed or not once the page is read."""

    line: Line
    names: tuple[int, ...]


class _Open(NamedTuple):
    name: str
    boilerplate: bool
    names: tuple[int, ...]
    article: int
    link: bool


CERTAIN, STRONG, WEAK = 3, 2, 1


def _doubt(name: str, attributes: str) -> int:
    """How sure an element's name and attributes are that it holds no article text, 0 if they don't say so."""
    if name in BOILERPLATE_ELEMENTS:
        return WEAK if name == "form" else CERTAIN
    if not attributes or name in ("body", "html") or name in ARTICLE_ELEMENTS and "comment" not in attributes.lower():
        return 0
    found = 0
    for attribute, value in _ATTRIBUTE.findall(attributes.lower()):
        value = value.strip("\"'")
        if attribute == "hidden" or attribute == "aria-hidden" and value.strip() == "true":
            return CERTAIN
        if attribute == "style" and _NOT_SHOWN.search(value):
            return CERTAIN
        if attribute in ("class", "id", "role"):
            found = max(found, *map(_named, value.split()), 0)
    return found


def _named(name: str) -> int:
    """Whether a class, id or role is "hidden" or has a boilerplate word that no word of layout stands before."""
    if name == "hidden":
        return CERTAIN
    for word in _WORD.findall(name):
        if word in LAYOUT_WORDS:
            break
        if word in BOILERPLATE_WORDS:
            return WEAK if word in WRAPPER_WORDS else STRONG
    return 0


def lines_of(html: str) -> list[Line]:
    """The page's lines with their marks, empty ones left out unless they are boilerplate."""
    lines: list[_Raw] = []
    stack: list[_Open] = [_Open("", False, (), 0, False)]
    opened: Counter[str] = Counter()  # elements on the stack
    parts: list[str] = []
    links = 0
    articles = 0
    doubts: list[int] = []  # of named elements, by number
    last_end: dict[str, int] = {}  # where the last closing tag of an element stands

    def closes_later(name: str, at: int) -> bool:
        if name not in last_end:
            last_end[name] = max((m.start() for m in re.finditer(f"</{re.escape(name)}\\b", html, re.IGNORECASE)), default=-1)
        return last_end[name] > at

    def flush() -> None:
        nonlocal links
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            top = stack[-1]
            lines.append(_Raw(Line(text, links, top.article, top.boilerplate), top.names))
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if text:
            parts.append(text)
            if stack[-1].link:
                links += len(text.strip())

    def open_(element: _Open) -> None:
        stack.append(element)
        opened[element.name] += 1

    def close(depth: int) -> None:
        for element in stack[depth:]:
            opened[element.name] -= 1
        del stack[depth:]

    at = 0
    while (start := _TAG_START.search(html, at)) is not None:
        add(html[at : start.start()])
        at = start.start()
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = end + 3 if end >= 0 else len(html)
            continue
        if html[at + 1] in "!?":
            end = html.find(">", at)
            at = end + 1 if end >= 0 else len(html)
            continue
        token = _TAG.match(html, at)
        if token is None:
            at = len(html)  # the page is cut inside a tag
            break
        at = token.end()
        name = token["name"].lower()
        inline = name in INLINE_ELEMENTS
        if token["end"]:
            if not inline:
                flush()
            if not opened[name]:
                continue
            depth = len(stack) - 1
            # A closing inline tag does not close the block around it.
            while depth and stack[depth].name != name and (not inline or stack[depth].name in INLINE_ELEMENTS):
                depth -= 1
            if depth and stack[depth].name == name:
                close(depth)
            continue
        top = stack[-1]
        if not inline:
            flush()
        if name in VOID_ELEMENTS or token["attributes"].endswith("/") and name not in UNPARSED_ELEMENTS:
            continue
        if name in RAW_ELEMENTS:
            end = _END_OF[name].search(html, at) if closes_later(name, at) else None
            if end is not None:
                at = end.end()
            elif name in UNPARSED_ELEMENTS:
                at = len(html)
            else:
                open_(top._replace(name=name, boilerplate=True))
            continue
        if not inline and len(stack) > 1 and name in ("p", "li", "tr", "td", "dt", "dd", "option"):
            # These end an open one of their kind; inline tags left open in it end too.
            inner = len(stack) - 1
            while inner and stack[inner].name in INLINE_ELEMENTS:
                inner -= 1
            if inner and stack[inner].name == name:
                close(inner)
            top = stack[-1]
        doubt = 0 if top.boilerplate else _doubt(name, token["attributes"])
        if doubt and not closes_later(name, at):
            doubt = 0
        article, names = top.article, top.names
        if name in ARTICLE_ELEMENTS and not top.boilerplate and not doubt:
            # The page's own mark says more than a wrapper's name.
            names = tuple(n for n in names if doubts[n] == STRONG)
            if not article and not names:
                articles += 1
                article = articles
        if doubt in (WEAK, STRONG) and len(names) < MOST_NAMES:
            names = (*names, len(doubts))
            doubts.append(doubt)
        open_(_Open(name, top.boilerplate or doubt == CERTAIN, names, article, top.link or name == "a"))
    add(html[at:])
    flush()
    return _believed(lines, doubts)


def _believed(lines: list[_Raw], doubts: list[int]) -> list[Line]:
    """Lines of named elements are boilerplate, unless the name stands around too much of the page's text.

    A wrapper's name ("menu-open", "sticky-header") is not believed if the element surges and holds over half of the text
    outside of certain boilerplate. If what is left never surges, the names around the highest surge are not believed, from
    the outermost inwards, until it does.
    """
    if not doubts:
        return [raw.line for raw in lines]
    mass, total = [0] * len(doubts), 0
    for line, names in lines:
        if not line.boilerplate and not any(doubts[n] == STRONG for n in names):
            total += line.prose
            for n in names:
                mass[n] += line.prose
    wrong = {n for n, d in enumerate(doubts) if d == WEAK and mass[n] >= SURGE and 2 * mass[n] > total}

    def marked() -> list[Line]:
        return [x._replace(boilerplate=x.boilerplate or any(n not in wrong for n in names)) for x, names in lines]

    found = marked()
    height, at = _highest([raw.line for raw in lines])
    # From the outermost name inwards.
    for name in lines[-at].names if height >= SURGE else ():
        if _highest(found)[0] >= SURGE:
            break
        wrong.add(name)
        found = marked()
    return found


def _highest(lines: list[Line]) -> tuple[int, int]:
    """The largest window sum, and where it first begins (negative, so that the first of equals is the maximum)."""
    own = [0 if x.boilerplate else x.prose for x in lines]
    return max(((sum(own[i : i + WINDOW]), -i) for i in range(len(own))), default=(0, 0))


class _Region(NamedTuple):
    mass: float
    marked: bool
    surges: bool
    lines: list[Line]


def _regions(run: list[Line]) -> list[_Region]:
    """Of lines that stand in one article element, or of lines outside of any, between surge and dive points."""
    marked = bool(run[0].article)
    if marked:
        # Inside the page's own article gaps are no borders.
        run = [x for x in run if not x.boilerplate]
    # Links in an article belong to its text, but do not speak for it.
    own = [0 if x.boilerplate else x.prose for x in run]
    lengths = [len(x.text) for x in run] if marked else own
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    regions = []
    i = 0
    while i < len(run):
        end = i
        while end < len(run) and sums[end]:
            end += 1
        if end > i:
            mass = sum(own[i:end]) * (ARTICLE_WEIGHT if marked else 1)
            lines = [run[k] for k in range(i, end) if lengths[k]]
            regions.append(_Region(mass, marked, max(sums[i:end]) >= SURGE, lines))
        i = max(end, i + 1)
    return regions


def _main_lines(lines: list[Line]) -> list[Line]:
    """Lines between surge and dive points, of the regions with most text."""
    regions = [r for _, run in groupby(lines, lambda x: x.article) for r in _regions(list(run))]
    outside = [r for r in regions if r.surges and not r.marked]
    marked = [r for r in regions if r.marked]
    # Where nothing surges the curve tells nothing: the page's own marks decide.
    if marked or outside:
        regions = marked + outside
    most = max((r.mass for r in regions), default=0)
    own = bool(marked) and max(r.mass for r in marked) >= most
    kept = [r for r in regions if r.marked and own or r.mass >= SHARE * most]
    found = {id(x) for r in kept for x in r.lines}
    return [x for x in lines if id(x) in found]


def main_text(html: str | None) -> str:
    return " ".join(x.text for x in _main_lines(lines_of(html or "")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


@query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
