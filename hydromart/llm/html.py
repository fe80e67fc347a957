"""Main-text extraction: streaming parser events, text-to-tag ratios, smoothing, threshold clusters.

The standard library's parser feeds each page as events. Block-level tags cut the page into lines;
a line's ratio is its text length over the tags it holds, and lines inside navigation, headers,
footers, sidebars, notices, adverts, forms and comments count as empty. The ratios are smoothed by
a Gaussian, and smoothed lines above a threshold (a share of their standard deviation) form the
content clusters. A chosen line seeds its region (the innermost article, section, div, list or table
around it) if its own ratio reaches the threshold too and it is not a short line of links.

Where no article is marked, regions with a seed are kept whole, so short blocks beside long ones
stay; a region without one is dropped if links hold most of its text, unless it stands between two
seeds of the region around it. If nothing seeds, all lines stay. A marked article that lies in no
excluded part is kept whole by its mark, whatever its ratios; outside the articles, the lines of a
region from its first to its last seed of ``PROSE`` or more characters are kept as well.

Defined results: null, empty or tag-free input gives its own text or none; unclosed and stray tags
are tolerated (a void or unknown tag never swallows the rest); repeated rows get equal results;
an empty table gives no rows; columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import ship

SIGMA = 1.0
SHARE = 0.25  # of the standard deviation of the smoothed ratios
PROSE = 80  # characters of a line that counts as prose by itself

# HTML element roles.
_BLOCK = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option
p pre search section select summary table tbody td textarea tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template noscript head title iframe object svg canvas audio video".split())
_EXCLUDED = frozenset("nav header footer aside form menu dialog search button select textarea".split())
_MAIN = frozenset(("article", "main"))
_REGIONS = frozenset("article blockquote body center details div dl main ol section table td th ul".split())
_ENDS_P = _BLOCK - {"br", "option", "caption", "legend", "summary"}
_EXCLUDED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banners?|sponsor(?:ed)?|promo(?:tion)?s?|cookies?(?:[\s_-]?\w+)?|consent|"
    r"notices?|sidebars?|side|navigation|navbar|nav|menus?|breadcrumbs?|footers?|comments?|respond|replies|"
    r"newsletter|subscribe|popup|modal|related|share|social|widgets?)(?:$|[\s_-])", re.IGNORECASE)
_EXCLUDED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_WHITE = re.compile(r"\s+")


class _Lines(HTMLParser):
    """Turns parser events into lines: text outside excluded parts, tags seen, article, region, characters in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool, int, bool]] = []  # tag, excluded, article, raw, region, link
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.articles = 0
        self.around = [0]  # the region around each region; 0 is the page
        self._parts: list[str] = []
        self._tags = self._linked = 0
        self._state = (False, 0, False, 0, False)  # excluded, article (0: none), raw, region, link

    def _cut(self) -> None:
        text = _WHITE.sub(" ", "".join(self._parts)).strip()
        if text or self._tags:
            self.lines.append((text, self._tags, self._state[1], self._state[3], self._linked))
        self._parts, self._tags, self._linked = [], 0, 0

    def _restore(self) -> None:
        self._state = self.open[-1][1:] if self.open else (False, 0, False, 0, False)

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._close("p", within=_BLOCK - {"p"})
        if tag == "li":
            self._close("li", within=frozenset(("ul", "ol", "menu")))
        if tag == "a":
            self._close("a", within=_BLOCK)
        if tag in _BLOCK:
            self._cut()
        self._tags += 1
        if tag in _VOID:
            return
        excluded, article, raw, region, link = self._state
        named = dict(attrs)
        names = f"{named.get('class') or ''} {named.get('id') or ''}"
        hidden = "hidden" in named or (named.get("aria-hidden") or "") == "true"
        out = (excluded or hidden or (tag in _EXCLUDED and not (tag == "header" and article))
               or (named.get("role") or "").lower() in _EXCLUDED_ROLES
               or (tag not in ("body", "html") and tag not in _MAIN
                   and bool(_EXCLUDED_NAMES.search(names))))
        if tag in _MAIN and not out and not article:
            self.articles += 1
            article = self.articles
        if tag in _REGIONS:
            self.around.append(region)
            region = len(self.around) - 1
        self.open.append((tag, out, article, raw or tag in _RAW, region, link or tag == "a"))
        self._restore()

    def handle_startendtag(self, tag, attrs):
        if tag in _BLOCK:
            self._cut()
        self._tags += 1

    def _close(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if tag in _BLOCK:
                    self._cut()
                del self.open[at:]
                self._restore()
                return
            if self.open[at][0] in within:
                return

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self._cut()
        self._tags += 1
        # an inline end tag never closes a block around it
        self._close(tag, within=frozenset() if tag in _BLOCK or tag in _RAW else _BLOCK)

    def handle_data(self, data):
        if not (self._state[0] or self._state[2]):
            self._parts.append(data)
            if self._state[4]:
                self._linked += len("".join(data.split()))

    def close(self):
        super().close()
        self._cut()


def _smooth(ratio: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, reach), kernel / kernel.sum(), mode="valid")


def extract(html: str, sigma: float = SIGMA, share: float = SHARE) -> str:
    """The main text of one page: its blocks in order, joined by newlines."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratio = np.array([len(text) / max(1, tags) for text, tags, *_ in lines])
    smooth = _smooth(ratio, sigma)
    chosen = (smooth >= share * smooth.std()) & (ratio >= share * smooth.std())
    marked = any(text and article for text, _, article, _, _ in lines)
    ends: dict[int, tuple[int, int]] = {}  # first and last seed of each region
    size: dict[int, int] = {}
    links: dict[int, int] = {}
    for i, (text, _, article, region, linked) in enumerate(lines):
        own = len(text) - text.count(" ")
        size[region], links[region] = size.get(region, 0) + own, links.get(region, 0) + linked
        plain, prose = 2 * linked <= own, len(text) >= PROSE
        if text and chosen[i] and ((plain and prose and not article) if marked else (plain or prose)):
            ends[region] = (ends.get(region, (i,))[0], i)

    def between(i: int, region: int) -> bool:
        return region in ends and ends[region][0] <= i <= ends[region][1]

    def kept(i: int, article: int, region: int) -> bool:
        if marked:
            return bool(article) or between(i, region)
        return (not ends or region in ends or 2 * links[region] <= size[region]
                or between(i, parser.around[region]))

    return "\n".join(text for i, (text, _, article, region, _) in enumerate(lines) if text and kept(i, article, region))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every page."""
    ship(pages.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([extract(h.as_py() or "") for h in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], names=["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
