"""Operator 4: main text of HTML pages.

The standard library's streaming parser turns a page into blocks (the page's lines). Each block has a text-to-tag
ratio; the logarithms of the ratios are smoothed by a Gaussian along the page, and blocks whose smoothed ratio reaches
a threshold between the two clusters form the content regions; a heading right before a region belongs to it. This
decides on every page. What a page marks itself is a weight on the smoothed ratio: 6 within an article, 4 within a
main, 1 elsewhere, and 0 for furniture (navigation, header, footer, aside, forms, adverts, notices, comments, and their
like), which therefore never enters. An element is furniture by its name, its role, or a class or id made of nothing
but furniture words and words of place (`site-header`, `ad-slot-2`; but not `legal-history`). The clusters are those of the
ratios before weighting, and furniture's 0 is among them, so a page of content alone isn't split. No part of a page is
left out for its place alone.

Defined cases: a null, empty or text-free page gives ''; unclosed tags end with their parent or with the page; a stray
end tag closes nothing; a page cut off in a tag loses that tag only; a CDATA section is text; repeated rows are pages of
their own; an empty table gives an empty result; pages are read whole, one at a time, in time proportional to their
length; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements of the HTML standard by their role here.
SILENT = frozenset("script style noscript template svg iframe object head title select option textarea button canvas audio video math".split())
FURNITURE = frozenset("nav header footer aside form menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK = HEADINGS | frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose start ends an open one of the same name, and those that don't end an open paragraph.
ENDS_ITS_LIKE = frozenset("p li dd dt tr td th".split())
WITHIN_PARAGRAPH = frozenset("body html".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu alertdialog".split())
#: Words of class names: what names furniture, and what may stand beside it without naming anything else.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer masthead comment comments disqus reply replies respond share sharing social related recommended recommendations widget widgets login signup search pagination pager skip toolbar copyright legal disclaimer".split()
)
PLACES = frozenset(
    "site page post main top bottom left right upper lower global primary secondary inner outer box block container wrapper wrap section area bar slot unit list links link form content buttons button item items text google inline sticky mobile desktop".split()
)
KINDS = {"article": 2, "main": 1}
#: Weights on the smoothed ratio by level; the threshold is never above CLEAR, the ratio of undoubted prose.
WEIGHTS, CLEAR = (1.0, 4.0, 6.0), math.log1p(40)
_SPACE, _PART = re.compile(r"\s+"), re.compile(r"[a-z]+")


def furniture_word(names: str) -> str | None:
    """The furniture word of a class or id attribute, if one of its names is made of such words and words of place."""
    for name in names.lower().split():
        parts = _PART.findall(name)
        named = [w for w in parts if w in NAMES]
        if named and all(w in NAMES or w in PLACES for w in parts):
            return named[0]
    return None


class _Blocks(HTMLParser):
    """Collects (text, tags in it, linked characters, level, heading) of each block; level 2 lies in an article, 1 in a main.

    A frame is an open block element with the inline elements open in it; counts of both tell stray end tags at once.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, int, bool]] = []
        self.frames: list[tuple[str, tuple, list, Counter]] = [("", (False, 0, False), [], Counter())]
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.hidden, self.level, self.link = False, 0, False

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.blocks.append((text, self.tags, self.linked, self.level, self.frames[-1][0] in HEADINGS))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
            around = self.frames[-1][0]
            if around == tag and tag in ENDS_ITS_LIKE or around == "p" and tag not in WITHIN_PARAGRAPH:
                self._close_frame()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag == "body":  # whatever the head left open ends here
            while len(self.frames) > 1:
                self._close_frame()
            self.frames[0][2].clear()
            self.frames[0][3].clear()
            self.hidden, self.level, self.link = False, 0, False
        before = (self.hidden, self.level, self.link)
        if tag in BLOCK:
            self.frames.append((tag, before, [], Counter()))
            self.open[tag] += 1
        else:
            _, _, inline, count = self.frames[-1]
            inline.append((tag, before))
            count[tag] += 1
        found = dict(attrs)
        words = [w for k in ("class", "id") if (w := furniture_word(found.get(k) or ""))]
        marked = tag not in ("html", "body", "article", "main") and any(w != "header" or self.level < 2 for w in words)
        in_article = self.level == 2 and tag == "header"  # an article's own header holds its title
        if tag in SILENT or (tag in FURNITURE and not in_article) or marked or found.get("role") in ROLES or "hidden" in found:
            self.hidden = True
        self.level = max(self.level, KINDS.get(tag, 0))
        self.link = self.link or tag == "a"

    handle_startendtag = handle_starttag

    def _close_frame(self) -> None:
        tag, (self.hidden, self.level, self.link), _, _ = self.frames.pop()
        self.open[tag] -= 1

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.flush()
            while self.open[tag]:
                last = self.frames[-1][0]
                self._close_frame()
                if last == tag:
                    return
            return
        _, _, inline, count = self.frames[-1]  # an inline end tag closes no block
        while count[tag]:
            last, (self.hidden, self.level, self.link) = inline.pop()
            count[last] -= 1
            if last == tag:
                return

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.link:
                self.linked += len(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):
            self.handle_data(data[6:])


def smooth(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing along the page; weights beyond the page's ends are left out."""
    r = math.ceil(3 * sigma)
    w = [math.exp(-((i / sigma) ** 2) / 2) for i in range(r + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - r), min(len(values), i + r + 1))
        out.append(sum(values[j] * w[abs(i - j)] for j in near) / sum(w[abs(i - j)] for j in near))
    return out


def two_means(values: list[float]) -> float:
    """The midpoint of two clusters on a line."""
    values = sorted(values)
    sums = [0.0, *accumulate(values)]
    low, high = values[0], values[-1]
    for _ in range(50):
        cut = (low + high) / 2
        n = bisect_right(values, cut)
        if n == len(values):
            return cut
        new = sums[n] / n, (sums[-1] - sums[n]) / (len(values) - n)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def blocks_of(html: str | None) -> list[tuple[str, int, int, int, bool]]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


def chosen(blocks: list[tuple[str, int, int, int, bool]]) -> list[str]:
    """Texts of the blocks in content regions."""
    if not blocks:
        return []
    ratio = smooth([math.log1p(max(0, len(text) - linked) / (1 + tags)) for text, tags, linked, _, _ in blocks])
    cut = min(two_means([0.0, *ratio]), CLEAR)
    kept = [r * WEIGHTS[b[3]] >= cut for b, r in zip(blocks, ratio, strict=True)]
    for i in range(len(blocks) - 2, -1, -1):
        kept[i] = kept[i] or blocks[i][4] and kept[i + 1]
    return [b[0] for b, k in zip(blocks, kept, strict=True) if k]


def main_text(html: str | None) -> str:
    return "\n\n".join(chosen(blocks_of(html)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 64):
                c = b.slice(lo, 64)
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array([main_text(h.as_py()) for h in c.column(2)], pa.string())], ["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string")
