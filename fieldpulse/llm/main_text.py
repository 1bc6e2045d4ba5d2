"""Main text of web pages: parser events, text-to-tag ratios, smoothing and clustering.

The standard library's parser streams a page's events. Text between block boundaries is
a line; its ratio is its characters over its tags. Ratios are smoothed by a Gaussian
over neighbouring lines, and lines above a threshold, the standard deviation of the
smoothed ratios, form the content cluster. The element that holds the cluster is the
content region: where article and main elements hold most of it, the one that holds any
or the deepest element around all that do, else the deepest element with all of it. All lines of the region are kept, so short paragraphs and headings
between long ones stay, but not what stands in navigation, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, by element, role, class or
id. A name of several words counts only if all of them are such words or say nothing else,
so ``has-sidebar`` and ``related-work`` bar nothing; names of headings never count, ids of
sections inside an article only for comments. Where names would bar the page's main cluster,
the elements around it are spared and the whole page is the region. Runs of lines that are links alone go outside the
region, and in a region that is the whole body before and after the cluster.

Character references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined in page order by an empty line. Nothing else is dropped.

Defined cases: null and empty html give an empty text; markup without text gives an empty
text; text without markup is one block; unclosed and misnested elements end where the next
enclosing element ends; a tag cut off by the page's end is markup; repeated rows are extracted each; an empty table gives an empty
result. Extra columns pass through and may have any name.

Extraction is a map over pages without a shuffle; a task holds one page's lines at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fieldpulse.llm.common import slices

#: Lines; the width of the Gaussian.
SIGMA = 1.5
#: Share of the cluster's characters that articles have to hold to bound the region.
ARTICLE_SHARE = 0.5
#: Where names leave less than this share of the cluster's characters, they bar the main text.
LEFT_SHARE = 0.1
#: So many lines in a row that are links alone are a menu.
MENU_LINES = 3

# HTML's element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var br wbr img".split()
)
UNSEEN = set("script style head title noscript template iframe object svg math canvas audio video".split())
FURNITURE = set("nav footer aside form menu button select textarea dialog fieldset option datalist search".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CONTENT = {"article", "main"}
#: Open elements that a new one of the key's kind ends, and the elements that stop the search for them.
ENDS = {
    "p": ({"p"}, None), "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
P_ENDERS = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)
P_SCOPE = set(
    "article aside blockquote body button caption dd details div dt fieldset figure footer form header li main nav "
    "section table td th ul ol dl".split()
)

# Words in classes, ids and roles that mark what is not the article.
FURNITURE_WORDS = set(
    "ad ads adbox adslot adsbygoogle advert adverts advertisement advertising adsense banner bottombar breadcrumb breadcrumbs complementary "
    "consent contentinfo cookie cookies copyright dialog disclaimer footer gdpr login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices overlay pager pagination popup promo promotion recommended related "
    "search share sharing sidebar signup skip skiplink social sponsor sponsored subscribe subscription toolbar topbar "
    "alert alertdialog".split()
)
COMMENT_WORDS = set("comment comments commentlist discussion disqus replies reply respond responses".split())
HEADER_WORDS = {"header"}
#: Words that change nothing beside one of the above in a name.
PLAIN_WORDS = set(
    "active area article articles author avatar bar block blog body bottom box btn button buttons center col column "
    "component container content count cta date desktop dfp dropdown entry fixed floating form global google gpt heading "
    "icon icons image inner input item items js label leaderboard left legal lg link links list main md meta middle mobile "
    "module mpu news outer page pane panel post posts primary rail region right row secondary section site slot sm "
    "sticky story stories strip text thread title toggle tools top trail unit user widget widgets wrap wrapper xl xs zone".split()
)
#: Names that end so are the page's, and a section of a paper is called like a comment's place.
PAGE_WORDS = {"page"}
SECTION_NAMES = {"discussion"}
KNOWN_WORDS = FURNITURE_WORDS | COMMENT_WORDS | HEADER_WORDS | PLAIN_WORDS
#: The page itself, as a region.
WHOLE = {"", "html", "body"}
#: A tag that the page's end cuts off.
_CUT_TAG = re.compile(r"<[A-Za-z/!?]")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Line:
    text: str
    tags: int
    link_chars: int
    element: int
    kept: bool
    #: Barred by a name alone; inside an article.
    named: bool
    inside: bool


@dataclass
class _Element:
    tag: str
    number: int
    #: None, or why its text is no content: "unseen", "comment", "furniture", "named" or "header".
    barred: str | None
    block: int
    heading: bool = False
    inside: bool = False


class _Lines(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self, spared: set[int] | None = None):
        super().__init__(convert_charrefs=True)
        #: Elements whose names do not count, and those that a name bars.
        self.spared = spared or set()
        self.named: list[int] = []
        self.lines: list[Line] = []
        self.open: list[_Element] = [_Element("", 0, None, 0)]
        self.open_tags: Counter[str] = Counter()
        #: Per element its name and the block element around it; the first one is the page.
        self.names: list[str] = [""]
        self.parents: list[int] = [0]
        self.pieces: list[str] = []
        self.tags = 0
        self.links = 0
        self.link_chars = 0

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.open[-1]
            kept = top.barred is None or (top.barred == "header" and top.heading and top.inside)
            self.lines.append(Line(text, self.tags, self.link_chars, top.block, kept, top.barred == "named", top.inside))
        self.pieces, self.tags, self.link_chars = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            self.tags += 1
            if tag in ("br", "img", "wbr"):
                self.pieces.append(" " if tag != "wbr" else "")
                return
        else:
            self.flush()
            self.tags += 1
            self._end_implied(tag)
        if tag in VOID:
            return
        above, number = self.open[-1], len(self.names)
        self.names.append(tag)
        self.parents.append(above.block)
        self.open.append(_Element(
            tag, number, self._bar(tag, attrs), above.block if tag in INLINE else number,
            above.heading or tag in HEADINGS, above.inside or tag in CONTENT,
        ))
        self.open_tags[tag] += 1
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the closing slash, but for void elements

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        self.tags += 1
        if not self.open_tags[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._close(at)
                return
            if (tag in INLINE or tag == "p") and self.open[at].tag in P_SCOPE:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].barred != "unseen":
            self.pieces.append(data)
            if self.links:
                self.link_chars += len(data.strip())

    def _close(self, at: int) -> None:
        for element in self.open[at:]:
            self.open_tags[element.tag] -= 1
            self.links -= element.tag == "a"
        del self.open[at:]

    def _end_implied(self, tag: str) -> None:
        ended, scope = ENDS.get(tag, (None, None))
        for names, stop in (({"p"}, P_SCOPE) if tag in P_ENDERS else (None, None), (ended, scope or P_SCOPE)):
            if names and any(self.open_tags[n] for n in names):
                for at in range(len(self.open) - 1, 0, -1):
                    if self.open[at].tag in names:
                        self._close(at)
                        break
                    if self.open[at].tag in stop:
                        break

    def _bar(self, tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
        above = self.open[-1].barred
        if above in ("unseen", "comment"):
            return above
        if tag in UNSEEN:
            return "unseen"
        values = dict(attrs)
        if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style") or "", re.I):
            return "unseen"
        if tag == "body" or tag == "html":
            return None
        words = self._words(tag, values)
        if words & COMMENT_WORDS:
            return "comment"
        if tag in CONTENT:
            return None  # an article in an unclosed advert is still the article
        if above == "furniture" or tag in FURNITURE:
            return "furniture"
        if words & FURNITURE_WORDS and len(self.names) - 1 not in self.spared:
            self.named.append(len(self.names) - 1)
            return "named"
        return above if above == "named" else "header" if above or tag == "header" or words & HEADER_WORDS else None

    def _words(self, tag: str, values: dict[str, str | None]) -> set[str]:
        """Words of the element's names that can bar it."""
        found: set[str] = set()
        if tag in HEADINGS:
            return found
        for kind in ("class", "id", "role"):
            for name in (values.get(kind) or "").split():
                words = [w.lower() for w in _WORDS.findall(name)]
                known = all(w in KNOWN_WORDS or len(w) == 1 for w in words)
                if words and known and words[-1] not in PAGE_WORDS and not (len(words) == 1 and words[0] in SECTION_NAMES):
                    comments_only = kind == "id" and tag == "section" and self.open[-1].inside
                    found.update(COMMENT_WORDS.intersection(words) if comments_only else words)
        return found


def smoothed_ratios(lines: list[Line]) -> np.ndarray:
    """Text-to-tag ratio per line, smoothed by a Gaussian that is cut off at the ends."""
    ratios = np.array([len(line.text) / max(line.tags, 1) for line in lines])
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(lines)), kernel)[reach : reach + len(lines)]
    return np.convolve(ratios, kernel)[reach : reach + len(lines)] / weight


def _menus(lines: list[Line]) -> np.ndarray:
    """Lines in runs of at least ``MENU_LINES`` that are links alone."""
    bare = np.array([line.link_chars >= 0.9 * len(line.text.replace(" ", "")) and line.link_chars > 0 for line in lines])
    menu = np.zeros(len(lines), bool)
    start = 0
    for at in range(len(lines) + 1):
        if at == len(lines) or not bare[at]:
            if at - start >= MENU_LINES:
                menu[start:at] = True
            start = at + 1
    return menu


def _root(lines: list[Line], possible: np.ndarray, cluster: np.ndarray, names: list[str], parents: list[int]) -> int:
    """The element that is the content region."""
    count = len(names)
    #: Per element, with those below it: characters and lines of the cluster, possible lines.
    held, clustered, able = (np.zeros(count, np.int64) for _ in range(3))
    for at in np.flatnonzero(possible):
        able[lines[at].element] += 1
        if cluster[at]:
            held[lines[at].element] += len(lines[at].text)
            clustered[lines[at].element] += 1
    # An element is opened after those around it.
    for number in range(count - 1, 0, -1):
        for sums in (held, clustered, able):
            sums[parents[number]] += sums[number]
    within = np.zeros(count, bool)
    for number in range(1, count):
        within[number] = within[parents[number]] or names[parents[number]] in CONTENT
    articles = [n for n in range(count) if names[n] in CONTENT and clustered[n] and not within[n]]
    if articles and held[articles].sum() >= ARTICLE_SHARE * held[0]:
        # The article, or what is around all of them.
        wanted = np.zeros(count, np.int64)
        wanted[articles] = 1
        for number in range(count - 1, 0, -1):
            wanted[parents[number]] += wanted[number]
        return int(np.flatnonzero(wanted == len(articles))[-1])
    # The deepest element around the cluster: of those around one another, the last one opened. One line is no region.
    return int(np.flatnonzero((clustered == clustered[0]) & (able >= min(2, able[0])))[-1])


def _cluster(lines: list[Line], possible: np.ndarray) -> np.ndarray:
    """The possible lines above the threshold, or all where none is."""
    smooth = smoothed_ratios(lines)
    cluster = possible & (smooth >= smooth.std())
    return cluster if cluster.any() else possible


def _spared(parser: _Lines) -> set[int]:
    """Elements barred by a name that are around the page's main cluster."""
    lines = parser.lines
    if not parser.named or any(line.kept and line.inside for line in lines):
        return set()
    cluster = _cluster(lines, np.array([line.kept or line.named for line in lines]) & ~_menus(lines))
    chosen = [lines[at] for at in np.flatnonzero(cluster)]
    total = sum(len(line.text) for line in chosen)
    # One line is no cluster.
    if len(chosen) < 2 or sum(len(line.text) for line in chosen if line.kept) >= LEFT_SHARE * total:
        return set()
    held = np.zeros(len(parser.names), np.int64)
    for line in chosen:
        held[line.element] += len(line.text)
    for number in range(len(held) - 1, 0, -1):
        held[parser.parents[number]] += held[number]
    return {number for number in parser.named if held[number] >= ARTICLE_SHARE * total}


def _read(markup: str, spared: set[int] | None = None) -> _Lines:
    parser = _Lines(spared)
    parser.feed(markup)
    parser.close()
    parser.flush()
    return parser


def main_text(html: str | None) -> str:
    """The main text of one page."""
    html = html or ""
    cut = _CUT_TAG.search(html, html.rfind(">") + 1)
    markup = html[: cut.start()] if cut else html
    parser = _read(markup)
    if not parser.lines:
        return ""
    spared = _spared(parser)
    if spared:
        parser = _read(markup, spared)
    lines, names, parents = parser.lines, parser.names, parser.parents
    possible, menus = np.array([line.kept for line in lines]), _menus(lines)
    able = possible & ~menus
    if not able.any():
        able = possible & np.array([line.inside for line in lines])
    if not able.any():
        return ""
    cluster = _cluster(lines, able)
    root = 0 if spared else _root(lines, able, cluster, names, parents)
    region = np.zeros(len(names), bool)
    region[root] = True
    for number in range(root + 1, len(names)):
        region[number] = region[parents[number]]
    if names[root] in WHOLE:
        first, last = np.flatnonzero(cluster)[[0, -1]]
        possible[:first] &= ~menus[:first]
        possible[last:] &= ~menus[last:]
    return "\n\n".join(line.text for line, p in zip(lines, possible, strict=True) if p and region[line.element])


def extract(pages: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without ``html``, plus the main text and its length in code points."""
    kept = [f for f in pages.schema.fields if f.name not in ("html", text, n_chars)]
    schema = StructType([*kept, StructField(text, StringType()), StructField(n_chars, LongType())])
    names = [f.name for f in kept]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(h.as_py()) for h in batch.column(len(names))]
            arrays = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *arrays], names=[*names, text, n_chars])

    return pages.select(*names, "html").mapInArrow(read, schema)
