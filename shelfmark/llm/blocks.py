"""Main text of web pages from flat text blocks.

A page is cut into text blocks at block-level tags. Each block has a word count and a link density,
those of its two neighbours, and where it stands: inside an article, inside a part whose tag or name
says navigation, advert, comments and so on, in a heading or a paragraph. A decision tree, trained
on the small labelled table below, tells main text from the rest. Nothing else is dropped or cut.

What only a name (or a form around all) says is overruled where no article or main element stands
elsewhere on the page: by a name of main text on an element within, and for a part that holds most of
the page's words outside links.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Names of HTML elements, and name parts that sites give to parts of a page.
_SKIPPED = frozenset("script style noscript template textarea select title iframe svg canvas audio "
                     "video object".split())
#: Of these, the ones that hold plain characters; the others hold elements.
_RAW = frozenset("script style textarea title iframe".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                    "label mark q rp rt ruby s samp small span strike strong sub sup time tt u "
                    "var wbr".split())
_PLACES = frozenset("article main section div nav header footer aside form ul ol dl menu table body "
                    "fieldset dialog details button figure blockquote".split())
_VOID = frozenset("br img hr input meta link wbr area base col embed source track param".split())
_OUTSIDE = frozenset("nav footer aside form menu dialog button fieldset".split())
_OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside "
    "footer masthead topbar toolbar cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations trending comment comments commentlist respond disqus discussion replies reply "
    "reviews search widget copyright legal disclaimer skip contentinfo complementary".split())
_COMMENT_NAMES = frozenset("comment comments commentlist respond disqus discussion replies reply "
                           .split())
_INSIDE_NAMES = frozenset("content article main post entry story body text".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("words", "link_share", "words_before", "links_before", "words_after", "links_after",
            "outside", "inside", "heading", "paragraph")

#: The labelled table: the features above, then 1 for main text. Blocks of invented example pages.
LABELED = (
    # menus, headers, footers, sidebars, notices, adverts, forms, comments: marked as such
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 1, 0, 0, 0, 0),
    (6, 1.0, 2, 1.0, 30, 0.0, 1, 0, 0, 0, 0), (12, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0, 0),
    (25, 0.1, 3, 1.0, 9, 0.0, 1, 0, 0, 1, 0), (60, 0.0, 40, 0.0, 55, 0.0, 1, 0, 0, 1, 0),
    (9, 0.0, 45, 0.0, 0, 0.0, 1, 0, 0, 0, 0), (14, 0.3, 80, 0.0, 4, 1.0, 1, 0, 0, 0, 0),
    (35, 0.0, 70, 0.0, 20, 0.0, 1, 1, 0, 1, 0), (4, 0.0, 60, 0.0, 35, 0.0, 1, 1, 1, 0, 0),
    (3, 1.0, 50, 0.0, 2, 1.0, 1, 1, 0, 0, 0), (90, 0.0, 30, 0.0, 70, 0.0, 1, 1, 0, 1, 0),
    (5, 0.0, 12, 0.0, 3, 0.0, 1, 0, 1, 0, 0), (18, 0.5, 40, 0.0, 6, 1.0, 1, 1, 0, 0, 0),
    # the article: long and short paragraphs, headings, lists, links within
    (8, 0.0, 10, 0.2, 30, 0.0, 0, 1, 1, 0, 1), (1, 0.0, 8, 0.0, 40, 0.0, 0, 1, 1, 0, 1),
    (30, 0.0, 8, 0.0, 45, 0.0, 0, 1, 0, 1, 1), (55, 0.05, 30, 0.0, 60, 0.0, 0, 1, 0, 1, 1),
    (3, 0.0, 55, 0.0, 70, 0.0, 0, 1, 0, 1, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1, 1),
    (120, 0.0, 60, 0.0, 9, 0.0, 0, 1, 0, 1, 1), (10, 0.6, 40, 0.0, 35, 0.0, 0, 1, 0, 1, 1),
    (4, 1.0, 60, 0.0, 50, 0.0, 0, 1, 0, 1, 1), (6, 0.0, 5, 0.0, 7, 0.0, 0, 1, 0, 0, 1),
    (2, 1.0, 3, 1.0, 2, 1.0, 0, 1, 0, 0, 1), (40, 0.0, 12, 1.0, 10, 0.0, 0, 1, 0, 0, 1),
    (15, 0.0, 200, 0.0, 12, 0.5, 0, 1, 0, 1, 1), (7, 0.0, 1, 1.0, 20, 0.0, 0, 1, 1, 0, 1),
    # pages without an article: running text among unmarked boilerplate
    (40, 0.0, 35, 0.0, 50, 0.0, 0, 0, 0, 1, 1), (25, 0.05, 6, 0.0, 45, 0.0, 0, 0, 0, 1, 1),
    (18, 0.0, 40, 0.0, 30, 0.0, 0, 0, 0, 1, 1), (70, 0.1, 3, 1.0, 8, 0.5, 0, 0, 0, 1, 1),
    (90, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (6, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1, 1),
    (8, 0.0, 2, 1.0, 35, 0.0, 0, 0, 1, 0, 1), (5, 0.0, 28, 0.0, 33, 0.0, 0, 0, 1, 0, 1),
    (35, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 1), (12, 0.0, 45, 0.0, 50, 0.0, 0, 0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0), (5, 1.0, 3, 1.0, 40, 0.0, 0, 0, 0, 0, 0),
    (4, 0.9, 30, 0.0, 2, 1.0, 0, 0, 0, 1, 0), (12, 0.8, 4, 1.0, 6, 1.0, 0, 0, 0, 0, 0),
    (6, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (3, 0.0, 1, 0.0, 2, 1.0, 0, 0, 0, 0, 0),
    (4, 0.0, 3, 0.5, 0, 0.0, 0, 0, 0, 0, 0), (7, 0.4, 5, 1.0, 4, 0.5, 0, 0, 0, 0, 0),
    (2, 0.0, 3, 1.0, 4, 1.0, 0, 0, 1, 0, 0), (20, 0.9, 25, 0.8, 15, 1.0, 0, 0, 0, 0, 0),
    (1, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (9, 0.0, 1, 1.0, 3, 0.0, 0, 0, 0, 0, 0),
)


def grow(table: np.ndarray, label: np.ndarray, depth: int = 8):
    """A classification tree by least Gini impurity: a leaf's class, or (feature, cut, low, high)."""
    share = label.mean()
    best = None
    if depth and 0 < share < 1:
        for k in range(table.shape[1]):
            values = np.unique(table[:, k])
            for cut in (values[1:] + values[:-1]) / 2:
                low = table[:, k] <= cut
                impurity = sum(len(y) * y.mean() * (1 - y.mean()) for y in (label[low], label[~low]))
                if best is None or impurity < best[0] - 1e-12:
                    best = impurity, k, float(cut), low
    if best is None:
        return int(share >= 0.5)
    _, k, cut, low = best
    return k, cut, grow(table[low], label[low], depth - 1), grow(table[~low], label[~low], depth - 1)


_tree = None


def tree():
    """The tree of the labelled table, grown once per process (milliseconds)."""
    global _tree
    if _tree is None:
        rows = np.array(LABELED, dtype=float)
        _tree = grow(rows[:, :-1], rows[:, -1])
    return _tree


def decide(features, node) -> int:
    while not isinstance(node, int):
        k, cut, low, high = node
        node = low if features[k] <= cut else high
    return node


class _Place:
    """An element that blocks stand in, below its parent; ``hard`` marks it as outside for good, and
    ``soft`` by a name; ``main`` is an article or main element, ``named`` has a name of main text."""

    def __init__(self, name: str, parent: _Place | None, attributes: str = ""):
        self.name, self.parent, self.words = name, parent, 0
        self.main = name in ("article", "main")
        self.article = self.main or bool(parent and parent.article)
        self.hard = self.soft = self.named = False
        if name == "body":
            return
        parts = {p.lower() for m in _NAMES.finditer(attributes) for g in m.groups() if g
                 for p in _PART.findall(g)}
        if _HIDDEN.search(attributes) or parts & _COMMENT_NAMES:
            self.hard, self.main = True, False
            self.article = bool(parent and parent.article)
        elif not self.main and not parts & _INSIDE_NAMES:
            self.soft = name == "form" or bool(parts & _OUTSIDE_NAMES)
            self.hard = (name in _OUTSIDE and name != "form") or (
                name == "header" and not (parent and parent.article))
        self.named = bool(parts & _INSIDE_NAMES) and not self.hard and not parts & _OUTSIDE_NAMES


def _outside(places: list[_Place], count: int) -> None:
    """Set ``outside`` of every place; parents come first. ``count``: the page's words outside links;
    places have those of their own blocks."""
    for p in reversed(places):  # words and articles of what a place holds
        p.articles = getattr(p, "articles", 0) + p.main
        if p.parent:
            p.parent.words += p.words
            p.parent.articles = getattr(p.parent, "articles", 0) + p.articles
    articles = sum(p.main for p in places)
    plain = 0  # words in parts with a name of main text that nothing marks
    for p in places:
        up = p.parent
        p.marked = not p.main and (p.hard or p.soft or bool(up and up.marked))
        p.told = p.named or bool(up and up.told)
        if p.named and not p.marked and not (up and up.told):
            plain += p.words
    for p in places:
        up = p.parent
        alone = articles == p.articles  # no article or main element elsewhere
        hard, soft = (up.is_hard, up.is_soft) if up else (False, False)
        if p.main or (p.named and alone and p.words >= plain):
            soft = False
        p.is_hard = not p.main and (hard or p.hard)
        p.is_soft = soft or (p.soft and not (alone and 2 * p.words > count))
        p.outside = p.is_hard or p.is_soft


def _after(html: str, at: int, name: str, opened: Counter) -> int:
    """Where an element without raw text that begins before ``at`` ends: after its end tag, or, if it
    has none, before that of an element around it (``opened``)."""
    within, inner = [name], Counter([name])
    while True:
        start = html.find("<", at)
        if start < 0:
            return len(html)
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = len(html) if stop < 0 else stop + 3
            continue
        match = _TAG.match(html, start) or _LOOSE_TAG.match(html, start)
        if not match:
            at = start + 1
            continue
        at, tag = match.end(), match[1].lower()
        if html[start + 1] != "/":
            if match[2].endswith("/") or tag in _VOID:
                continue
            if tag in _RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else len(html)
                continue
            within.append(tag)
            inner[tag] += 1
        elif inner[tag]:
            while (last := within.pop()) != tag:
                inner[last] -= 1
            inner[tag] -= 1
            if not within:
                return at
        elif opened[tag]:
            return start


def segment(html: str) -> list[tuple[str, int, bool, bool, bool, bool]]:
    """Text blocks in page order: text, words in links, outside, inside, heading, paragraph."""
    blocks, pieces = [], []
    places: list[_Place] = []  # all, in page order
    place = None  # the nearest
    standing = Counter()  # names of places around
    around, opened = [], Counter()  # names of all elements around
    state = {"links": 0, "kind": "", "in_link": False}

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((text, state["links"], place, state["kind"] in _HEADINGS,
                           state["kind"] == "p"))
            if place:
                place.words += max(0, len(text.split()) - state["links"])
        pieces.clear()
        state["links"] = 0

    def add(text: str) -> None:
        text = unescape(text)
        pieces.append(text)
        if state["in_link"]:
            state["links"] += len(text.split())

    at, end = 0, len(html)
    while at < end:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        if start > at:
            add(html[at:start])
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        if html[start + 1:start + 2] in ("!", "?"):
            stop = html.find(">", start)
            at = end if stop < 0 else stop + 1
            continue
        match = _TAG.match(html, start) or _LOOSE_TAG.match(html, start)
        if not match:
            add("<")
            at = start + 1
            continue
        at, name, attributes = match.end(), match[1].lower(), match[2]
        closing = html[start + 1] == "/"
        if name in _SKIPPED and not closing:
            if not attributes.endswith("/") and name not in _RAW:
                at = _after(html, at, name, opened)
            elif not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
            continue
        if not closing and name not in _VOID and not attributes.endswith("/"):
            around.append(name)
            opened[name] += 1
        elif closing and opened[name]:
            while (last := around.pop()) != name:
                opened[last] -= 1
            opened[name] -= 1
        if name == "a":
            state["in_link"] = not closing
            continue
        if name in _INLINE:
            if name == "br":
                pieces.append("\n")
            continue
        flush()
        state["kind"] = "" if closing else name
        if name not in _PLACES or name in _VOID:
            continue
        if not closing:
            place = _Place(name, place, attributes)
            places.append(place)
            standing[name] += 1
        elif standing[name]:
            while place.name != name:
                standing[place.name] -= 1
                place = place.parent
            standing[name] -= 1
            place = place.parent
    flush()
    _outside(places, sum(max(0, len(b[0].split()) - b[1]) for b in blocks))
    return [(text, links, bool(p and p.outside), bool(p and p.article), heading, paragraph)
            for text, links, p, heading, paragraph in blocks]


def main_text(html: str | None) -> str:
    """The main text's blocks, one per line."""
    blocks = segment(html or "")
    counts = [len(b[0].split()) for b in blocks]
    shares = [min(1.0, b[1] / n) for b, n in zip(blocks, counts, strict=True)]
    kept, node, last = [], tree(), len(blocks) - 1
    for i, (text, _, outside, inside, heading, paragraph) in enumerate(blocks):
        features = (counts[i], shares[i],
                    counts[i - 1] if i else 0, shares[i - 1] if i else 0.0,
                    counts[i + 1] if i < last else 0, shares[i + 1] if i < last else 0.0,
                    outside, inside, heading, paragraph)
        if decide(features, node):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, html: str = "html", to: str = "text") -> DataFrame:
    """Add (or replace) ``to``: the page's main text, empty if there is none or html is null."""
    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x.as_py()) for x in batch], pa.string())
    return pages.withColumn(to, extracted(F.col(f"`{html}`")))
