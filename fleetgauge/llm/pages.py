"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks at block-level tags. Each block has its number of words and its link
density, those of the blocks before and after it, and where it stands (inside an article or main
element, inside a part that its tag or class names as something else). A decision tree, grown here
from the small labelled table below, decides which blocks belong to the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

# Elements by their part in a page.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "xmp"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "head"}
ARTICLE = {"article", "main"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "meter", "output", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "wbr", "math", "mi", "mn", "mo", "mrow", "msup", "msub", "mfrac", "svg", "text", "tspan",
}
ENDED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "footer", "sidebar", "aside", "widget", "related",
    "cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "share",
    "social", "comment", "comments", "disqus", "replies", "reply", "form", "search", "pagination", "pager", "copyright",
}
#: With one of these beside it a name tells the state of a container, as in no-sidebar or nav-open.
STATE_NAMES = {"no", "with", "without", "has", "is", "hide", "hidden", "show", "open", "closed", "on", "off", "enabled", "disabled"}
#: Parts that may also name the frame around an article; one inside them is text all the same.
FRAME_NAMES = {"nav", "menu", "header", "footer", "sidebar"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}

#: place: 0 in a part named as something else, 1 outside the article of a page that has one, 2 on a
#: page without article element, 3 inside an article.
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "place"]
# Labelled blocks, the features in the order above, then 1 for main text.
LABELLED = [
    # menus, footers, adverts, forms, notices and comments that a tag or class names
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0), (1, 1.0, 1, 1.0, 11, 0.0, 0, 0), (11, 0.0, 1, 1.0, 12, 0.0, 0, 0),
    (14, 0.0, 90, 0.0, 0, 0.0, 0, 0), (3, 0.5, 0, 0.0, 80, 0.0, 0, 0), (45, 0.0, 60, 0.0, 70, 0.0, 0, 0),
    (120, 0.0, 40, 0.0, 9, 0.2, 0, 0), (60, 0.1, 80, 0.0, 30, 0.0, 0, 0), (25, 0.0, 120, 0.0, 0, 0.0, 0, 0),
    (8, 0.9, 50, 0.0, 8, 0.9, 0, 0), (200, 0.0, 100, 0.0, 100, 0.0, 0, 0), (2, 0.0, 0, 0.0, 5, 0.0, 0, 0),
    # blocks of an article: headings, paragraphs, lists, also short or with some links
    (8, 0.0, 11, 0.0, 70, 0.0, 3, 1), (70, 0.0, 8, 0.0, 40, 0.0, 3, 1), (1, 0.0, 60, 0.0, 50, 0.0, 3, 1),
    (3, 0.0, 9, 0.0, 0, 0.0, 3, 1), (30, 0.1, 40, 0.0, 14, 0.0, 3, 1), (150, 0.05, 20, 0.0, 14, 0.0, 3, 1),
    (12, 0.3, 30, 0.0, 25, 0.0, 3, 1), (1, 0.0, 11, 0.0, 14, 0.0, 3, 1), (5, 0.0, 1, 1.0, 80, 0.0, 3, 1),
    (2, 1.0, 40, 0.0, 30, 0.0, 3, 1), (6, 0.8, 50, 0.0, 60, 0.0, 3, 1), (20, 0.0, 14, 0.0, 14, 0.0, 3, 1),
    # the like of what is dropped elsewhere, inside an article: short lists, link lists, credits
    (6, 0.9, 40, 0.0, 6, 0.9, 3, 1), (40, 0.8, 30, 0.7, 20, 0.9, 3, 1),
    (4, 0.0, 3, 1.0, 4, 1.0, 3, 1), (5, 0.4, 2, 1.0, 3, 0.5, 3, 1), (6, 0.0, 4, 0.5, 0, 0.0, 3, 1),
    (9, 0.0, 2, 0.8, 4, 0.9, 3, 1), (3, 0.0, 3, 0.0, 4, 0.0, 3, 1), (25, 0.6, 60, 0.0, 3, 1.0, 3, 1),
    (5, 0.0, 5, 0.0, 70, 0.0, 3, 1), (12, 1.0, 12, 0.0, 12, 0.0, 3, 1), (300, 1.0, 0, 0.0, 0, 0.0, 3, 1),
    # menus inside an article: blocks of nothing but links between others
    (2, 1.0, 2, 1.0, 2, 1.0, 3, 0), (1, 1.0, 4, 1.0, 3, 1.0, 3, 0), (5, 1.0, 2, 1.0, 6, 1.0, 3, 0),
    (3, 1.0, 1, 1.0, 1, 1.0, 3, 0), (9, 1.0, 7, 1.0, 12, 1.0, 3, 0), (4, 1.0, 8, 1.0, 2, 1.0, 3, 0),
    # outside the article of a page that has one
    (9, 0.0, 0, 0.0, 1, 1.0, 1, 0), (16, 0.0, 80, 0.0, 0, 0.0, 1, 0), (50, 0.0, 90, 0.0, 20, 0.0, 1, 0),
    (2, 1.0, 5, 0.0, 60, 0.0, 1, 0), (120, 0.1, 30, 0.0, 9, 0.0, 1, 0),
    # pages without an article element: by words and links of the block and its neighbours
    (60, 0.0, 9, 0.0, 50, 0.0, 2, 1), (90, 0.1, 70, 0.0, 4, 1.0, 2, 1), (30, 0.05, 40, 0.0, 40, 0.0, 2, 1),
    (18, 0.0, 40, 0.0, 35, 0.0, 2, 1), (8, 0.0, 3, 0.9, 60, 0.0, 2, 1), (4, 0.0, 50, 0.0, 70, 0.0, 2, 1),
    (25, 0.0, 60, 0.0, 3, 1.0, 2, 1), (7, 0.1, 45, 0.0, 30, 0.0, 2, 1), (150, 0.2, 5, 0.0, 6, 0.5, 2, 1),
    (20, 0.0, 2, 1.0, 25, 0.0, 2, 1), (40, 0.0, 0, 0.0, 0, 0.0, 2, 1), (22, 0.0, 0, 0.0, 3, 0.9, 2, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 2, 0), (6, 0.9, 40, 0.0, 6, 0.9, 2, 0), (40, 0.8, 30, 0.7, 20, 0.9, 2, 0),
    (4, 0.0, 3, 1.0, 4, 1.0, 2, 0), (5, 0.4, 2, 1.0, 3, 0.5, 2, 0), (6, 0.0, 4, 0.5, 0, 0.0, 2, 0),
    (9, 0.0, 2, 0.8, 4, 0.9, 2, 0), (3, 0.0, 3, 0.0, 4, 0.0, 2, 0), (25, 0.6, 60, 0.0, 3, 1.0, 2, 0),
]

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>?|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z))", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def grow(rows: np.ndarray, labels: np.ndarray, depth: int):
    """A tree of (feature, threshold, at most, above) tuples with shares of label 1 as leaves; each
    cut has the least Gini impurity, the first of equals."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= cut
            a, b = labels[low], labels[~low]
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), low)
    if best is None:
        return share
    _, f, cut, low = best
    return (f, cut, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


@lru_cache(1)
def tree():
    data = np.array(LABELLED, float)
    return grow(data[:, :-1], data[:, -1], 6)


def _is_main(node, row: tuple) -> bool:
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node >= 0.5


def _named_aside(attributes: str) -> tuple[bool, bool]:
    """Whether class, id or role name a part that is no text, and whether as a frame only."""
    named = frame = False
    for name, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            named |= value.strip() in ASIDE_ROLES
            continue
        for one in value.split():
            parts = set(_PARTS.split(one))
            if not parts.isdisjoint(ASIDE_NAMES) and parts.isdisjoint(STATE_NAMES):
                if parts & ASIDE_NAMES <= FRAME_NAMES:
                    frame = True
                else:
                    named = True
    return named or frame, frame and not named


class _Open:
    """The open elements. Each entry knows whether it lies in an article and in a part that is no text,
    so that no question looks through the stack."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool, bool]] = []  # name, in an article, set aside, as a frame only
        self.count: dict[str, int] = {}

    def state(self) -> tuple[bool, bool]:
        return self.stack[-1][1:3] if self.stack else (False, False)

    def push(self, name: str, attributes: str) -> None:
        named, frame = (False, False) if name in ("html", "body") else _named_aside(attributes)
        if name in ASIDE:
            named, frame = True, False
        self._add(name, name in ARTICLE, named, frame)

    def _add(self, name: str, article: bool, named: bool, frame: bool) -> None:
        _, inside, aside, framed = self.stack[-1] if self.stack else (name, False, False, False)
        if article and not named and framed:  # the frame's name doesn't speak of an article in it
            aside = framed = False
        if named:
            framed = frame and (framed or not aside)
        self.stack.append((name, inside or article, aside or named, framed))
        self.count[name] = self.count.get(name, 0) + 1

    def close(self, name: str) -> None:
        while self.count.get(name):
            last = self.stack.pop()[0]
            self.count[last] -= 1
            if last == name:
                return

    def end_kind(self, name: str) -> None:
        """An element of this kind ends an open one that only others of the kind are open in."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] not in ENDED:
                return
            if self.stack[i][0] == name:
                self.stack[i:] = self.stack[i + 1 :]  # the few behind it keep their flags
                self.count[name] -= 1
                return


def blocks(page: str) -> Iterator[tuple[str, int, int, bool, bool]]:
    """(text, words, words in links, in an article, set aside) of each non-empty block in order, in time
    linear in the page however deep elements are nested."""
    text: list[str] = []
    links: list[str] = []
    open_ = _Open()
    in_link, at, size = False, 0, len(page)

    def flush():
        if not text:
            return None
        whole = " ".join(html.unescape("".join(text)).split())
        linked = len(html.unescape(" ".join(links)).split())
        text.clear()
        links.clear()
        if not whole:
            return None
        return whole, whole.count(" ") + 1, linked, *open_.state()

    while at < size:
        found = _TAG.search(page, at)
        piece = page[at : found.start()] if found else page[at:]
        if piece:
            text.append(piece)
            if in_link:
                links.append(piece)
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if name == "a":
            in_link = not closing
        elif name == "br":
            text.append(" ")
        if name in RAW and not closing:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name in INLINE and (closing or not _NAMES.search(attributes) or not _named_aside(attributes)[0]):
            if not closing or not open_.count.get(name):
                continue
        if block := flush():
            yield block
        if name != "a":
            in_link = False
        if closing:
            open_.close(name)
        elif name not in VOID and not attributes.endswith("/"):
            if name in ENDED:
                open_.end_kind(name)
            open_.push(name, attributes)
    if block := flush():
        yield block


def main_text(page: str | None) -> str:
    """Main text of a whole page, its blocks joined by line feeds; empty for NULL."""
    found = list(blocks(page or ""))
    has_article = any(b[3] for b in found)
    outside = ("", 0, 0, False, False)
    kept = []
    for before, block, after in zip([outside, *found], found, [*found[1:], outside]):
        row = (
            block[1], block[2] / block[1], before[1], before[2] / max(before[1], 1), after[1], after[2] / max(after[1], 1),
            0 if block[4] else 3 if block[3] else 1 if has_article else 2,
        )
        if _is_main(tree(), row):
            kept.append(block[0])
    return "\n".join(kept)


def extracted(pages: DataFrame, name: str = "text", page: str = "html") -> DataFrame:
    """`pages` with the main text `name` (replaced if there). Every row stays; pages without main
    text, empty and NULL pages get an empty text."""
    rest = [c for c in pages.columns if c != name]
    pages = pages.select(*rest)
    at = rest.index(page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*rest, name])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(name, T.StringType())]))


def query(spark, sf_dir: str) -> DataFrame:
    rows = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
