"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

A page is one stream of events of the standard library's parser; no tree is built. Every block of text becomes a line
with its characters, the tags met in it and the containers it stands in. Lines in menus, headers, footers, sidebars,
notices, adverts, forms and comments have the ratio 0. The ratios of all lines are smoothed, lines at or above the
threshold (one standard deviation, or the mean if that is less) form the content cluster, and the container that holds
the cluster is the content region: its lines are the text, short ones between long ones included.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines to both sides that the smoothing looks at, and its standard deviation in lines.
REACH, SIGMA = 2, 1.0
#: Without an article: the container that holds this share of the cluster's characters is the region.
REGION_SHARE = 0.9
#: A list of at least so many items, all of them links, is a menu.
MENU_ITEMS = 2
#: Characters that are handed to the parser at a time.
FEED = 1 << 16

# Elements of HTML by what they do.
SKIPPED = frozenset("script style noscript template head iframe object svg math canvas audio video map datalist".split())
BOILERPLATE = frozenset("nav footer aside form header button select textarea dialog menu fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening block ends an open paragraph; these end an open element of their own kind.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

#: Words of a class, id or role that mark an element as something other than the article.
MARKS = frozenset(
    "nav navigation navbar menu menubar submenu breadcrumb breadcrumbs sidebar sidebars aside complementary ad ads advert adverts "
    "advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "notification alert announcement popup modal overlay dialog newsletter subscribe subscription signup footer contentinfo header "
    "masthead topbar toolbar share sharing social related recommended recommendations comment comments disqus respond reply replies "
    "widget widgets pagination pager paywall login search searchbox form skip copyright hidden".split()
)
#: Marks whose part may hold articles of its own; an article in another part means that its end tag is missing.
HOLDS_ARTICLES = frozenset("comment comments disqus respond reply replies related recommended recommendations sidebar sidebars aside complementary widget widgets promo footer form hidden".split())
#: A class that begins so says something of the page, not of the element.
ABOUT = ("has-", "with-", "no-", "is-", "without-")


def marks(attrs: list[tuple[str, str | None]]) -> set[str]:
    """The marking words of an element's class, id and role; ``hidden`` for what is not shown."""
    found = set()
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.add("hidden")
        elif name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.add("hidden")
        elif name in ("class", "id", "role") and value:
            for word in value.split():
                if not word.lower().startswith(ABOUT):
                    parts = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", word)
                    found |= MARKS.intersection(re.split(r"[^a-z]+", parts.lower()))
    return found


@dataclass
class Element:
    tag: str
    number: int
    hard: bool  # left out by its kind, with all that stands in it
    soft: bool  # left out by its class
    words: frozenset = frozenset()
    items: int = 0


@dataclass
class Line:
    path: tuple[int, ...]
    hard: bool
    soft: bool
    heading: bool
    item: int  # the list that the line is an item of, or -1
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    text: str = ""


class Lines(HTMLParser):
    """The lines of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Element("", 0, False, False)]
        self.counts: Counter = Counter()
        self.kinds = [""]
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.tags = 0
        self.links = self.skipped = 0

    def element(self, tag: str, attrs: list[tuple[str, str | None]]) -> Element:
        above, words = self.open[-1], frozenset()
        if tag not in ("html", "body"):
            words = frozenset(marks(attrs))
            if tag in ("article", "main"):
                words &= HOLDS_ARTICLES - {"widget", "widgets", "related", "sidebar", "aside", "promo", "form"}
        hard = above.hard or (tag in BOILERPLATE and not (tag == "header" and self.inside("article")))
        self.kinds.append(tag)
        header = tag == "header" or "header" in words
        return Element(tag, len(self.kinds) - 1, hard, above.soft or bool(words) or header, words)

    def inside(self, tag: str) -> bool:
        return any(e.tag == tag for e in self.open)

    def end_line(self) -> None:
        if self.line is not None:
            self.line.text = " ".join("".join(self.line.parts).split())
            if self.line.text:
                self.line.tags += self.tags
                self.lines.append(self.line)
                self.tags = 0
            else:
                self.tags += self.line.tags
            self.line = None

    def pop_to(self, at: int) -> None:
        for e in self.open[at:]:
            self.skipped -= e.tag in SKIPPED
            self.links -= e.tag == "a"
        del self.open[at:]

    def close_implied(self, tag: str) -> None:
        """End what an opening ``tag`` ends without a tag of its own."""
        for at in range(len(self.open) - 1, 0, -1):
            kind = self.open[at].tag
            if kind in SIBLINGS.get(tag, ()):
                self.pop_to(at)
                return
            if kind in SCOPES.get(tag, ()):
                return
            if kind == "p":
                self.pop_to(at)
            elif kind not in INLINE and tag not in SIBLINGS:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            if self.line is None:
                self.tags += 1
            else:
                self.line.tags += 1
            if tag == "br" and self.line is not None:
                self.line.parts.append(" ")
        else:
            self.end_line()
            self.tags += 1
            self.close_implied(tag)
            if tag in ("article", "main"):
                self.leave_parts()
            elif tag == "body":
                self.pop_to(next((k for k, e in enumerate(self.open) if e.tag == "head"), len(self.open)))
        if tag in VOID:
            return
        if tag == "li":
            self.open[-1].items += 1
        self.open.append(self.element(tag, attrs))
        self.skipped += tag in SKIPPED
        self.links += tag == "a"

    def leave_parts(self) -> None:
        """An article in a menu or an advert: that part was never closed."""
        for at, e in enumerate(self.open):
            if (e.tag in ("nav", "header", "button", "menu", "select", "textarea", "head") and not e.words & HOLDS_ARTICLES) or (e.words and not e.words & HOLDS_ARTICLES):
                self.pop_to(at)
                return
            if e.tag in ("article", "main") or e.words or e.tag in BOILERPLATE:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # only void elements end themselves in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_line()
        at = next((k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == tag), None)
        if at is not None and (tag not in INLINE or all(e.tag in INLINE for e in self.open[at:])):
            self.pop_to(at)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![`` outside of foreign content begins a comment that ends at the next ``>``."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def handle_data(self, data: str) -> None:
        if self.skipped:
            return
        if self.line is None:
            if not data.strip():
                return
            path = tuple(e.number for e in self.open if e.tag not in INLINE)
            heading = any(e.tag in HEADINGS for e in self.open)
            lists = [e.number for e in self.open if e.tag in ("ul", "ol")]
            top, soft = self.open[-1], self.open[-1].soft
            if soft and heading and self.inside("article"):  # the headings in an article's own header stay
                soft = any((e.words - {"header"}) or (e.tag == "header" and not article) for e, article in self.within())
            self.line = Line(path, top.hard, soft, heading, lists[-1] if lists else -1)
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len("".join(data.split()))

    def within(self) -> Iterator[tuple[Element, bool]]:
        article = False
        for e in self.open:
            article |= e.tag == "article"
            yield e, article

    @classmethod
    def of(cls, html: str) -> Lines:
        parser = cls()
        for at in range(0, len(html), FEED):
            parser.feed(html[at : at + FEED])
        parser.close()
        parser.end_line()
        return parser


def smoothed(ratios: np.ndarray, reach: int = REACH, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel's part inside counts."""
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / inside


def cluster(ratios: np.ndarray) -> np.ndarray:
    """Which lines are content: smoothed ratios at or above one standard deviation or the mean, whichever is less."""
    smooth = smoothed(ratios)
    return (smooth >= min(smooth.std(), smooth.mean()) - 1e-9) & (ratios > 0)


def menus(lines: list[Line]) -> set[int]:
    """Lists whose items are links and nothing else."""
    total, linked, items = Counter(), Counter(), Counter()
    for line in lines:
        if line.item >= 0:
            total[line.item] += len("".join(line.text.split()))
            linked[line.item] += line.linked
            items[line.item] += 1
    return {k for k in items if items[k] >= MENU_ITEMS and linked[k] >= total[k]}


def region(page: Lines, kept: list[Line], content: np.ndarray) -> list[Line]:
    """The lines of the container that holds the content cluster."""
    weight: Counter = Counter()
    for line, yes in zip(kept, content.tolist(), strict=True):
        if yes:
            for number in line.path:
                weight[number] += len(line.text)
    # the outermost articles, else the main part, that hold any of the cluster
    for kind in ("article", "main"):
        roots = {next((n for n in line.path if page.kinds[n] == kind), None) for line in kept} - {None}
        roots = {n for n in roots if weight[n] > 0}
        if roots:
            return [line for line in kept if roots.intersection(line.path)]
    total = weight[0]
    shared = [n for n, w in weight.items() if w >= REGION_SHARE * total and page.kinds[n] not in ("p", "pre", "blockquote", "td", "li", *HEADINGS)]
    inner = max(shared)  # containers that hold most of it are nested, the innermost was opened last
    return [line for line in kept if inner in line.path]


def main_text(html: str | None) -> str:
    """The main text of one page: its blocks in page order, one a line; empty if there is none."""
    if not html:
        return ""
    page = Lines.of(html)
    shown = [line for line in page.lines if not line.hard]
    lists = menus(shown)
    wanted = [not line.hard and not line.soft and line.item not in lists for line in page.lines]
    if not any(wanted):  # a page that is marked as something else from top to bottom
        wanted = [not line.hard and line.item not in lists for line in page.lines]
    if not any(wanted):
        return ""
    ratios = np.array([len(line.text) / max(1, line.tags) if yes else 0.0 for line, yes in zip(page.lines, wanted, strict=True)])
    content = cluster(ratios)
    if not content.any():
        content = ratios >= ratios.max()
    kept = [line for line, yes in zip(page.lines, wanted, strict=True) if yes]
    return "\n".join(line.text for line in region(page, kept, content[np.array(wanted)]))


def extract(pages: DataFrame, html: str = "html", prefix: str = "") -> DataFrame:
    """All columns but ``html``, with (prefix)text and (prefix)n_chars, its code points; those must not be there yet.

    A null or empty page, and one that has no main text, gives an empty text. Rows are judged one by one, so that
    repeated rows give equal texts; a page is held in one task's memory, together with its lines.
    """
    others = [c for c in pages.columns if c != html]
    clash = {f"{prefix}text", f"{prefix}n_chars"} & set(others)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already: give a prefix")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(others).schema]
    schema = ", ".join([*kinds, f"`{prefix}text` string", f"`{prefix}n_chars` bigint"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(value.as_py()) for value in batch.column(len(others))]
            columns = [*batch.columns[: len(others)], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, f"{prefix}text", f"{prefix}n_chars"])

    return pages.select(*others, html).mapInArrow(texts, schema)
