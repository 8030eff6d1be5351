"""Main text of web pages from parser events, text-to-tag ratios and smoothing.

One pass of the standard library's parser cuts a page into lines: a line is the text of a block, between two tags that start
or end one. A single br is white space inside a line; two or more end it. Each line has its ratio of text outside links to
tags, as a logarithm; the ratios, smoothed with a Gaussian over neighbouring lines, are clustered in two by a threshold.
Above it a line speaks for the elements around it with each of its characters, below it against them; the element for which
most speaks is the region, and its lines are the text, short ones too. If all elements have more against them, as
paragraphs straight in the body between long menus, the lines above the threshold are the text.

Elements are hints. What is in a menu, a footer, a control or a script, by name or role, has ratio 0 and is never text. A
class or id that says advert, comments, sidebar and the like does the same for its element, unless that holds the main
element, the heading or most of the page, and is mere layout then; an ambiguous one halves the ratio, and inside the region
its element goes if its lines are below the threshold. An article or main element speaks a quarter louder.

Every step is linear in the page: elements have numbers and ranges of lines, and open ones are found by name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lean, text_of, trim

#: Names of elements, by what they do to lines.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head title script style noscript template iframe object svg canvas math audio video nav footer aside button select option textarea menu dialog label input datalist fieldset".split())
MAINS = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: An element that starts one of these ends an open paragraph; li, dt and so on end their own kind, up to a holder.
CLOSES_P = BLOCKS - frozenset("body html head title option optgroup td th tr li dd dt caption legend summary tbody thead tfoot".split())
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDERS = frozenset("ul ol dl table div article section main body".split())
#: Words of a class or id. APART: its element isn't the article, however much of the page it has. STRONG: nor is it where such
#: a word is the whole name, or its first or last part. Others are hints only. STATE: parts of names that tell of layout.
APART = frozenset("nav navbar navigation menu breadcrumb breadcrumbs aside footer related recommended comment comments disqus reply replies respond ad ads advert adverts advertisement advertising sponsor sponsored".split())
STRONG = APART | frozenset("promo promotion sidebar widget cookie cookies consent gdpr popup modal newsletter subscribe signup login share sharing social pager pagination masthead topbar toolbar banner notice copyright".split())
HINTS = STRONG | frozenset("side foot overlay legal skip hidden search header".split())
STATE = frozenset("has no with without open closed on off wrap wrapper layout by".split())
_UNENDED = re.compile(r"<[A-Za-z/!?]")
_SPACE, _PART = re.compile(r"\s+"), re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")

#: Widest deviation of the smoothing, in lines; the ratio from which a line is above the threshold at any rate; how much louder
#: a main element speaks.
SIGMA, SURE, LOUDER = 1.0, 10.0, 1.25


def mark(value: str) -> int:
    """What a class or an id says of its element: 0 nothing, 1 an ambiguous hint, 2 not the article, 3 apart from it."""
    out = 0
    for token in _SPACE.split(value.strip()):
        parts = [x.lower() for x in _PART.split(token) if x]
        if not parts or not STATE.isdisjoint(parts) and len(parts) > 1:
            continue
        ends = {parts[0], parts[-1]}
        out = max(out, 3 if ends & APART else 2 if ends & STRONG else 1 if not HINTS.isdisjoint(parts) else 0)
    return out


class _Page(HTMLParser):
    """Lines and elements of a page.

    A line is (text, characters, characters outside links, tags), without text where all of it is inside elements that are
    never content. An element is a block with the range of its lines, its mark (-1 where it's never content) and the number
    after those of the elements inside it; element 0 is the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.names, self.starts, self.ends, self.marks, self.last = ["page"], [0], [0], [0], [1]
        self.open: list[tuple[str | None, int, bool, bool]] = [("page", 0, False, False)]  # name, element or -1, never, inside a main element
        self.at: dict[str, list[int]] = {}  # places of open elements in that list, by name
        self.holders: list[int] = [0]
        self.blocks: list[int] = [0]
        self.parts: list[str] = []
        self.links = self.unseen = self.tags = self.breaks = 0

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.unseen:
            self.lines.append((text, len(text) or self.unseen, max(0, len(text) - self.links), self.tags))
            self.tags = 0
        self.parts.clear()
        self.links = self.unseen = self.breaks = 0

    def _close(self, k: int) -> None:
        """End the open elements from place k on."""
        if self.blocks[-1] >= k:
            self.cut()
        while len(self.open) > k:
            name, element, *_ = self.open.pop()
            if name is not None:
                self.at[name].pop()
            if self.holders[-1] >= len(self.open):
                self.holders.pop()
            if element >= 0:
                self.blocks.pop()
                self.ends[element], self.last[element] = len(self.lines), len(self.names)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        if tag == "br":
            self.breaks += 1
            self.parts.append("\n")
            if self.breaks > 1:
                self.cut()
            return
        for name in (*OWN_KIND.get(tag, ()), *(("p",) if tag in CLOSES_P else ())):
            places = self.at.get(name)
            if places and (i := bisect_right(places, self.holders[-1])) < len(places):
                self._close(places[i])
        if tag in EMPTY:
            return
        never, inside = self.open[-1][2:]
        never = never or tag in NEVER or tag == "header" and not inside
        said = 2 if tag == "form" else 0
        for name, value in attrs:
            if name == "hidden" or value and (name == "role" and value.strip().lower() in ROLES or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value)):
                never = True
            elif value and name in ("class", "id") and tag in BLOCKS and tag not in ("html", "body", "main"):
                said = max(said, mark(value))
        place, element = len(self.open), -1
        if tag in BLOCKS:
            element = len(self.names)
            self.names.append(tag)
            self.starts.append(len(self.lines))
            self.ends.append(len(self.lines))
            self.marks.append(-1 if never else said)
            self.last.append(element + 1)
            self.blocks.append(place)
        if tag in HOLDERS:
            self.holders.append(place)
        self.at.setdefault(tag, []).append(place)
        self.open.append((tag, element, never, inside or tag in MAINS))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
        if not (places := self.at.get(tag)):
            return
        k = places[-1]
        if tag in BLOCKS or self.blocks[-1] < k:
            self._close(k)
        else:  # an inline end tag across blocks: the element goes, what it holds stays
            places.pop()
            self.open[k] = (None, *self.open[k][1:])

    def handle_data(self, data: str) -> None:
        if self.open[-1][2]:
            self.unseen += len(data.strip()) if self.open[-1][0] not in ("script", "style") else 0
            return
        if self.breaks and not data.isspace():
            self.breaks = 0
        self.parts.append(data)
        if self.at.get("a"):
            self.links += len(data)

    def finish(self, html: str) -> "_Page":
        """Read a whole page. What follows the last > can't be a tag, and what looks like the start of one is dropped, as the
        parser would look for the end of each over and over."""
        last = html.rfind(">") + 1
        self.feed(html[:last])
        self.close()
        tail = _UNENDED.split(html[last:], maxsplit=1)[0]
        if tail:
            self.handle_data(unescape(tail))
        self._close(1)
        self.cut()
        self.ends[0], self.last[0] = len(self.lines), len(self.names)
        return self


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; beyond the ends the first and last value go on."""
    r = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, r, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(level: np.ndarray, sure: float = SURE) -> float:
    """Between the two clusters that the levels fall into (2-means), but not above that of a ratio of `sure`."""
    at = float(level.mean())
    for _ in range(20):
        low, high = level[level <= at], level[level > at]
        if not len(low) or not len(high) or at == (new := float(low.mean() + high.mean()) / 2):
            break
        at = new
    return min(at, float(np.log1p(sure)))


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(values)])


def main_text(html: str | None, sigma: float = SIGMA, smoother=smooth) -> str:
    """The main text, blocks joined by a line feed; empty for null and empty pages and pages without content."""
    if not html:
        return ""
    p = _Page().finish(html)
    if not any(t for t, *_ in p.lines):
        return ""
    chars, plain, tags = (np.array([x[k] for x in p.lines], dtype=np.float64) for k in (1, 2, 3))
    seen = np.array([bool(x[0]) for x in p.lines])
    start, end, marks = np.array(p.starts), np.array(p.ends), np.array(p.marks)
    name = np.array(p.names)

    prose = _sums(np.where(seen, plain, 0.0))
    share = (prose[end] - prose[start]) / max(1.0, prose[-1])
    heads = _sums(np.isin(name, ["article", "main", "h1"]) & (marks >= 0))
    last = np.array(p.last)

    def holds(kinds: list[str]) -> np.ndarray:
        n = _sums(np.isin(name, kinds) & (marks >= 0))
        return n[last] - n[np.arange(len(name)) + 1] > 0

    others = heads[-1] - (heads[last] - heads[np.arange(len(name))]) > 0
    layout = holds(["main"]) | holds(["h1"]) & (share >= 0.2) | (marks < 3) & (share > 0.5) & ~others
    out = np.zeros(len(chars) + 1)
    half = np.zeros(len(chars) + 1)
    for grown, which in ((out, (marks >= 2) & ~layout), (half, (marks == 1) & ~layout)):
        np.add.at(grown, start[which], 1)
        np.add.at(grown, end[which], -1)
    out, half = np.cumsum(out)[:-1] > 0, np.cumsum(half)[:-1] > 0

    ratio = np.where(seen & ~out, plain / np.maximum(1, tags), 0.0) * np.where(half, 0.5, 1.0)
    level = smoother(np.log1p(ratio), sigma)
    least = threshold(level)
    # what is never text speaks against all around it
    says = _sums(chars * np.where(ratio > 0, level - least, -max(least, 1e-9)))
    score = says[end] - says[start]
    score = np.where(np.isin(name, list(MAINS)) & (score > 0), score * LOUDER, score)
    score[np.isin(name, ["p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "tr", "caption"])] = -np.inf
    found = score.max() > 0
    root = int(score.argmax()) if found else 0

    a, b = int(start[root]), int(end[root])
    keep = seen & ~out & (found | (level >= least) & ((ratio > 0) | (not ratio.any())))
    for k in np.nonzero((marks == 1) & ~layout & (start >= a) & (end <= b) & (says[end] - says[start] < 0))[0]:
        if k != root:
            keep[start[k] : end[k]] = False
    own = [i for i in range(a, b) if keep[i]]
    if any(plain[i] > 0 for i in own):  # a list of nothing but links at either end is a menu
        for side in (1, -1):
            run = 0
            for i in own[::side]:
                if plain[i] > 0:
                    break
                run += 1
            if run >= 3:
                own = own[run:] if side > 0 else own[:-run]
    return "\n".join(p.lines[i][0] for i in own)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row for each row, from the whole html, without a shuffle.

    Null and empty html give an empty text; broken markup is read as far as the parser's events go; very long pages are
    read whole, in time and memory linear in their length. Null ids and urls, repeated rows, extra columns and an empty
    table need no care.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
        trim()

    rows = lean(pages).select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), text_of(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
