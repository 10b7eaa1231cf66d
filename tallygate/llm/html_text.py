"""Main text of web pages by the distribution of line blocks.

Markup is stripped to lines, one for each block of text. Elements that are never part of an article
(menus, page headers, footers, sidebars, notices, adverts, forms, scripts, comments; by element, class,
role or id) leave no lines. Where a container begins or ends outside an article and outside ``<main>``,
``WINDOW`` empty lines stand, so the text length summed over a sliding window of lines falls to
nothing there. It surges where a container's text begins and dives where it ends; what lies
between is a region, short lines included.

On every page the regions whose highest window is ``SURGE`` characters or more stay. Windows in an
``<article>``, or in a ``<main>`` without one, count ``MARKED`` times, and with such windows on a page, others
have to reach a ``MARKED``-th of the highest: a text beside an article stays only if it rises as high as the
article does, and a teaser's article can't outdo the text beside it. Of a region outside these, all that stands
in its container between the first and the last text that isn't a menu stays as well. If none rises so
high, the longest region stays.

Names that don't tell enough (``share``, ``widget``, ``cookie-bar``, a form around the whole page) leave an
element out only if no window of it surges, links not counted; its windows outside an article count a
``MARKED``-th while other text rises.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import slices

WINDOW = 3
SURGE = 150
#: What a window counts in an article, against one outside.
MARKED = 4
#: A region of which links make up a larger share is a menu.
MOST_LINKED = 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|noscript|template|textarea|svg|iframe|select|object|math)\b[^>]*(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_CONTAINERS = frozenset("article aside body div footer form header main nav section table ul ol dl".split())
#: Containers that hold a part of a page, not a list or table of it.
_PARTS = frozenset("aside div footer form header nav section".split())
_BLOCKS = _CONTAINERS | frozenset(
    "address blockquote caption center dd details dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr "
    "li menu p pre summary tbody tfoot thead tr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("aside button dialog footer menu nav".split())
_DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer gdpr masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promotion recommended related replies "
    "reply sidebar sponsor sponsored subscribe".split()
)
#: Names that texts have as well.
_DOUBTFUL_NAMES = frozenset("alert dialog form login overlay search share sharing social toolbar widget".split())
#: Parts of a name that say how something else is laid out.
_ABOUT = frozenset("has is no non not with without".split())


def _names(attributes: str) -> set[str]:
    found = set()
    for _, *values in _NAMES.findall(attributes):
        found.update("".join(values).lower().split())
    return found


def _compound(names: set[str]) -> bool:
    """Whether a name such as ``cookie-bar`` begins or ends with one that drops an element."""
    for name in names:
        parts = re.split("[-_]+", name)
        if len(parts) > 1 and not _ABOUT.intersection(parts) and _DROPPED_NAMES.intersection((parts[0], parts[-1])):
            return True
    return False


class Line(NamedTuple):
    text: str
    article: int = 0  # its number on the page; 0: none
    main: int = 0
    linked: int = 0  # characters in links
    container: int = 0
    doubtful: bool = False


def _surges(lines: list[Line]) -> bool:
    """Whether a window of the lines has ``SURGE`` characters outside links."""
    sizes = [max(0, len(x.text) - x.linked) for x in lines]
    return any(sum(sizes[k : k + WINDOW]) >= SURGE for k in range(len(sizes)))


class _Doubts:
    """Open elements of doubtful name; at their end their lines stay if they surge."""

    def __init__(self, lines: list[Line], spans: list[list[int]]):
        self.lines, self.spans = lines, spans
        self.open: list[list] = []  # name, first line, first container, elements of this name, surged
        self.named: dict[str, list[int]] = {}  # places in open

    def begin(self, name: str) -> None:
        self.named.setdefault(name, []).append(len(self.open))
        self.open.append([name, len(self.lines), len(self.spans), 1, False])

    def nested(self, name: str) -> None:
        if self.named.get(name):
            self.open[self.named[name][-1]][3] += 1

    def ends(self, name: str) -> bool:
        """Take an end tag; whether it ends a doubtful element."""
        if not self.named.get(name):
            return False
        own = self.open[self.named[name][-1]]
        own[3] -= 1
        return own[3] == 0

    def settle(self, name: str | None = None) -> None:
        """End the innermost element of the name and all in it; without a name, all."""
        down = self.named[name][-1] if name else 0
        while len(self.open) > down:
            own, first, container, _, surged = self.open.pop()
            self.named[own].pop()
            if surged or _surges(self.lines[first:]):
                if self.open:
                    self.open[-1][4] = True
            else:
                del self.lines[first:]
                for span in self.spans[container:]:
                    span[:] = [first, first]


def lines_of(page: str) -> tuple[list[Line], list[list[int]]]:
    """The lines of a page, and the first line and the line after the last of each container. Containers
    outside articles and mains stand apart by empty lines."""
    lines: list[Line] = []
    spans = [[0, 0]]  # container 0 is the page
    inside: list[tuple[str, int]] = []  # open containers
    doubts = _Doubts(lines, spans)
    mains = main = 0  # mains seen, and open ones
    parts: list[str] = []
    article = articles = depth = linked = 0  # depth: of articles; linked: characters in links of this line
    in_link = False
    skip, skips = "", 0  # the element that is being left out, and how often it is open

    def end_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            container = inside[-1][1] if inside else 0
            lines.append(Line(text, article, mains * (main > 0), linked, container, bool(doubts.open)))
        linked = 0

    def end_region() -> None:
        end_line()
        lines.extend([Line("")] * WINDOW)

    def apart() -> None:
        end_line() if depth or main else end_region()

    at = 0
    for m in _TAG.finditer(page):
        if not skip and m.start() > at:
            parts.append(page[at : m.start()])
            linked += in_link * (m.start() - at)
        at = m.end()
        close, name = m[2], (m[3] or "").lower()
        if not name:
            continue
        if skip:
            if name == skip and name not in _VOID:
                skips += -1 if close else 1
            if skips <= 0 or (name in ("article", "main") and not close) or (skip == "p" and name in _BLOCKS):
                skip = ""
                if name not in ("article", "main") and not (m[3] and not close and name in _BLOCKS):
                    continue
            else:
                continue
        if doubts.named.get("p") and name in _BLOCKS and not (close and name == "p"):  # a block ends a paragraph
            apart()
            doubts.settle("p")
        if close and doubts.ends(name):
            apart()
            doubts.settle(name)
            apart()
        elif not close and name not in _VOID and name not in ("html", "body"):
            own = _names(m[4])
            # the header of an article is part of it
            drop = name in _DROPPED or (name == "header" or "header" in own) and not depth
            drop = drop or bool(own & _DROPPED_NAMES) and name != "main" or bool(_HIDDEN.search(m[4]))
            doubtful = name == "form" or bool(own & _DOUBTFUL_NAMES) or _compound(own)
            within = depth or main or name in ("article", "main")
            if drop or within and name not in ("article", "main") and (name == "form" or _compound(own)):
                apart()
                if not m[4].endswith("/"):
                    skip, skips = name, 1
                continue
            if doubtful and name not in ("article", "main") and not m[4].endswith("/"):
                apart()
                doubts.begin(name)
            else:
                doubts.nested(name)
        if name in ("article", "main") and not close and not depth and doubts.open:
            end_line()
            doubts.settle()
        if name == "article":
            end_region() if depth <= 1 else end_line()
            depth = max(0, depth + (-1 if close else 1))
            if depth == 1 and not close:
                articles += 1
            article = articles if depth else 0
        elif name == "main" and not depth:
            end_region() if main <= 1 else end_line()
            main = max(0, main + (-1 if close else 1))
            mains += main == 1 and not close
        elif name in _CONTAINERS and not depth and not main:
            end_region()
            if name in _PARTS and not close:
                inside.append((name, len(spans)))
                spans.append([len(lines), -1])
            elif close and any(name == x for x, _ in inside):
                ended = ""
                while ended != name:
                    ended, number = inside.pop()
                    spans[number][1] = len(lines)
        elif name in _BLOCKS:
            end_line()
        elif name in ("br", "td", "th"):
            parts.append(" ")
        elif name == "a":
            in_link = not close
    if not skip:
        parts.append(page[at:])
    end_line()
    doubts.settle()
    return lines, [[a, len(lines) if b < 0 or not k else b] for k, (a, b) in enumerate(spans)]


class Region(NamedTuple):
    begin: int
    end: int
    peak: int  # characters of its highest window


def regions(lines: list[Line]) -> list[Region]:
    """Each stretch between surge and dive, from its first line to the one after its last."""
    sizes = [len(x.text) for x in lines]
    found, begin, peak = [], None, 0
    total = sum(sizes[:WINDOW])
    for k in range(len(sizes)):
        if total and begin is None:
            begin, peak = k, 0
        if begin is not None and not total:
            found.append((begin, k, peak))
            begin = None
        peak = max(peak, total)
        total += (sizes[k + WINDOW] if k + WINDOW < len(sizes) else 0) - sizes[k]
    if begin is not None:
        found.append((begin, len(sizes), peak))
    # windows look ahead
    return [Region(next(k for k in range(a, b) if sizes[k]), b, peak) for a, b, peak in found]


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks in page order, one on each line. Null or empty: empty."""
    lines, spans = lines_of(page or "")
    found = regions(lines)
    with_articles = {x.main for x in lines if x.article}

    def marked(r: Region) -> bool:
        first = lines[r.begin]
        return bool(first.article or first.main and first.main not in with_articles)

    def chars(r: Region) -> int:
        return sum(len(x.text) for x in lines[r.begin : r.end])

    def prosaic(r: Region) -> bool:
        return marked(r) or sum(x.linked for x in lines[r.begin : r.end]) <= MOST_LINKED * chars(r)

    def weight(r: Region) -> float:
        return MARKED if marked(r) else 1 / MARKED if lines[r.begin].doubtful else 1

    prose = [r for r in found if prosaic(r)]
    best = max([r.peak * MARKED for r in prose if marked(r)], default=0)
    least = max(SURGE, best / MARKED)
    risen = [r for r in prose if r.peak * weight(r) >= least] or [r for r in prose if r.peak >= SURGE]
    around = {lines[r.begin].container for r in risen if not marked(r)}
    risen = risen or prose and [max(prose, key=lambda r: chars(r) * weight(r))]
    kept = _contained(found, prose, set(risen), around, lines, spans)
    return "\n".join(x.text for r in kept for x in lines[r.begin : r.end] if x.text)


def _contained(
    found: list[Region], prose: list[Region], risen: set[Region], around: set[int], lines: list[Line], spans: list[list[int]]
) -> list[Region]:
    """The risen regions, and all between the first and the last prose of the containers ``around`` them; of
    what stands right in the body or the page, the prose that stands there too."""
    begins, prosaic = [r.begin for r in found], [r.begin for r in prose]
    covered = [0] * (len(found) + 1)
    for number in around - {0}:
        first, after = spans[number]
        held = prosaic[bisect_left(prosaic, first) : bisect_left(prosaic, after)]
        if held:
            covered[bisect_left(begins, held[0])] += 1
            covered[bisect_left(begins, held[-1]) + 1] -= 1
    in_body = {r for r in prose if not lines[r.begin].container and not lines[r.begin].article and not lines[r.begin].main}
    kept, open_ = [], 0
    for k, r in enumerate(found):
        open_ += covered[k]
        if open_ or r in risen or 0 in around and r in in_body:
            kept.append(r)
    return kept


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Nulls: a null html gives an empty text, null ids and urls stay. Repeated rows get a row each.
    Other columns are not looked at; an empty table gives no rows.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            text = pa.array(map(main_text, batch["html"].to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], text], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    found = rows.mapInArrow(extracted, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
