"""Main text of web pages by line-block distribution.

A page is read as a stream of tags and text.  Scripts, styles, comments
and boilerplate elements (by tag, role, whole class or id) are left out with
what they enclose, but not a wrapper with such a class or id that holds the
article or most of the page's text: its lines are judged like others; block tags end a line, inline tags vanish, character
references are decoded and white space in a line becomes one blank.
Boundaries of left-out elements and of the outermost ``article`` / ``main``
leave a gap of ``WINDOW`` empty lines; what is left out inside one of these
leaves none, nor does what stands in the story (an advert, a notice, a
video) with text before and after it under the same parent.

Each line has a weight: its length without link texts.  Where ``article``
and ``main`` hold at least half of that length, each line of theirs weighs
``SURGE / WINDOW`` more (``SURGE`` shared out in one of fewer lines), so a
window of them surges; where they hold less, as cards beside the text do,
they weigh what they are.  Weights are summed over sliding windows of
``WINDOW`` lines.  Text begins where a window reaches ``SURGE`` (the surge)
and ends at the next empty window (the dive); what lies between is kept,
for every such stretch of the page.  A page on which no window surges
gives its heaviest stretch.

Edge cases: null or empty html gives an empty text; unclosed elements end
with the page (unclosed boilerplate at the next ``article`` or ``main``);
text is kept whole at any length; repeated rows are treated alike.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import bounded, pylist, slices

WINDOW = 3
SURGE = 80

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|select|option)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[A-Za-z]+")

_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                    "sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_MAIN = frozenset(("article", "main"))
#: Elements whose class and id say nothing about what they hold.
_WHOLE_PAGE = frozenset(("html", "body", "main"))
#: Boilerplate tags that may also be wrapped around a whole page.
_WRAPPERS = frozenset(("form",))
#: Elements, roles and name parts that mark boilerplate.
_NOISE_TAGS = frozenset("nav footer aside form dialog menu button head audio video canvas".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion related respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split())


#: Boilerplate that divides a page: text on its two sides doesn't belong together.
_DIVIDER_TAGS = frozenset("nav footer header menu head".split())
_DIVIDER_NAMES = frozenset("breadcrumb breadcrumbs comment comments commentlist copyright disqus footer login masthead menu nav navbar "
                           "navigation pager pagination respond sidebar toolbar topbar".split())
_DIVIDER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar".split())
#: Elements that HTML lets end without a tag: what stands in them counts as standing in their parent.
_OPEN_ENDED = frozenset("p li dt dd tr thead tbody tfoot caption colgroup rp rt optgroup option".split())
#: Name parts that say only where or what kind of box an element is.
_PLACE_NAMES = frozenset("area bar block body bottom box container inner item left list main outer page right section site text top "
                         "wrap wrapper".split())


def _names_noise(token: str) -> bool:
    """Whether a whole class or id is a noise name, alone or with others and places ("site-footer", not "has-sidebar")."""
    parts = _PART.findall(token)
    return not _NOISE_NAMES.isdisjoint(parts) and all(p in _NOISE_NAMES or p in _PLACE_NAMES for p in parts)


def _noise(tag: str, attrs: str, inside: bool) -> str:
    """Why an element is boilerplate: "sure" by tag, role or attribute, "named" by all its names, "partly" by some; else ""."""
    if tag in _NOISE_TAGS or (tag == "header" and not inside):
        return "partly" if tag in _WRAPPERS else "sure"
    names: list[str] = []
    for name, *values in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in _NOISE_ROLES):
            return "sure"
        if name in ("class", "id") and tag not in _WHOLE_PAGE:
            names += value.split()
    noise = [_names_noise(n) for n in names]
    return "named" if noise and all(noise) else "partly" if any(noise) else ""


def _divides(tag: str, attrs: str) -> bool:
    if tag in _DIVIDER_TAGS:
        return True
    for name, *values in _ATTR.findall(attrs) if attrs else ():
        value = "".join(values).lower()
        if name.lower() == "role" and value in _DIVIDER_ROLES:
            return True
        if name.lower() in ("class", "id") and any(_names_noise(n) and not _DIVIDER_NAMES.isdisjoint(_PART.findall(n)) for n in value.split()):
            return True
    return False


class _Page:
    """The tags of a page, where each element ends, and how much text and how many articles come before each tag."""

    def __init__(self, page: str):
        self.tags = [m for m in _TOKEN.finditer(page)]
        self.ends = [len(self.tags)] * len(self.tags)
        self.closed = [False] * len(self.tags)
        self.text, self.mains = [0], [0]
        opened: dict[str, list[int]] = {}
        at = 0
        for k, m in enumerate(self.tags):
            main = False
            if m["tag"]:
                tag, attrs = m["tag"].lower(), m["attrs"]
                if m["end"]:
                    if opened.get(tag):
                        start = opened[tag].pop()
                        self.ends[start], self.closed[start] = k, True
                elif tag not in _VOID and not attrs.endswith("/"):
                    opened.setdefault(tag, []).append(k)
                    main = tag in _MAIN and not _noise(tag, attrs, True)
            self.text.append(self.text[-1] + len(page[at:m.start()].strip()))
            self.mains.append(self.mains[-1] + main)
            at = m.end()
        self.text.append(self.text[-1] + len(page[at:].strip()))
        self.mains.append(self.mains[-1])

    def holds_the_text(self, k: int, why: str, inside: bool) -> bool:
        """Whether the element that tag ``k`` opens is a wrapper: holds most of the page's text, or the article or main.

        One with noise names alone must hold all of these the page has; inside an article or main (its comments) it is none.
        """
        if why == "sure" or (inside and why == "named"):
            return False
        end = self.ends[k]
        held = self.mains[end] - self.mains[k]
        most = 2 * (self.text[end + 1] - self.text[k + 1]) > self.text[-1]
        if why == "named" and not self.closed[k]:
            return most and not held  # else left out up to the next article or main
        return most or (not inside and held > 0 and (why == "partly" or held == self.mains[-1]))


def lines_of(page: str) -> tuple[list[str], list[int]]:
    """The lines of a page and their weights."""
    texts: list[str] = []
    weights: list[int] = []
    where: list[int] = []  # the outermost article or main that holds the line, from 1; 0: none
    line: list[str] = []
    linked = depth = inside = marked = 0
    skip, in_link, open_ended = "", False, False
    parents: list[list] = [["", 0, True]]  # elements around here: tag, lines before it, whether still open
    opened: Counter = Counter()
    torn: list | None = None  # parent of what was left out after the last line: a gap is due if the next line is not in it

    def leave_gap() -> None:
        texts.extend([""] * WINDOW)
        weights.extend([0] * WINDOW)
        where.extend([0] * WINDOW)

    def close(gap: bool = False) -> None:
        nonlocal linked, torn
        text = " ".join(htmllib.unescape("".join(line)).split())
        line.clear()
        if text:
            if torn and not torn[2]:
                leave_gap()
            torn = None
            texts.append(text)
            weights.append(max(0, len(text) - linked))
            where.append(marked if inside else 0)
        if gap:
            leave_gap()
            torn = None
        linked = 0

    def enter_or_leave() -> None:
        if tag in _OPEN_ENDED or tag in _VOID or attrs.endswith("/"):
            return
        if not end:
            parents.append([tag, len(texts), True])
            opened[tag] += 1
        elif opened[tag]:
            while True:
                last = parents.pop()
                last[2] = False
                opened[last[0]] -= 1
                if last[0] == tag:
                    break

    at = 0
    tree = _Page(page)
    for k, m in enumerate(tree.tags):
        if not skip and m.start() > at:
            piece = page[at:m.start()]
            line.append(piece)
            linked += len(piece) if in_link else 0
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag, end, attrs = tag.lower(), m["end"], m["attrs"]
        if skip:
            if tag == skip:
                depth += -1 if end else 0 if attrs.endswith("/") else 1
            elif tag in _MAIN and not end and open_ended:
                depth = 0
            if depth > 0:
                continue
            skip = ""
            if tag not in _MAIN or end:
                continue
        why = "" if end or tag in _VOID or attrs.endswith("/") else _noise(tag, attrs, inside > 0)
        if why and not tree.holds_the_text(k, why, inside > 0):
            close()
            parent = parents[-1]
            if not inside:
                if _divides(tag, attrs) or len(texts) <= parent[1] or not texts[-1]:
                    close(gap=True)
                else:
                    torn = parent
            skip, depth, open_ended = tag, 1, not tree.closed[k]
        elif tag in _MAIN:
            close(gap=inside == (1 if end else 0))
            marked += not end and not inside
            inside = max(0, inside + (-1 if end else 1))
            enter_or_leave()
        elif tag == "a":
            in_link = not end
        elif tag not in _INLINE:
            close()
            in_link = False
            enter_or_leave()
    if not skip and at < len(page):
        line.append(page[at:])
    close()
    if marked and 2 * sum(n for n, w in zip(weights, where) if w) >= sum(weights):
        size = Counter(where)
        weights = [n - (-SURGE // min(WINDOW, size[w])) if w else n for n, w in zip(weights, where)]
    return texts, weights


def main_text(page: str | None) -> str:
    if not page:
        return ""
    texts, weights = lines_of(page)
    if not texts:
        return ""
    block = np.convolve(np.array(weights, np.int64), np.ones(WINDOW, np.int64))[WINDOW - 1:]  # weight of line i and the next ones
    surge = min(SURGE, int(block.max()))
    if not surge:
        return ""
    kept: list[str] = []
    i = 0
    while i < len(block):
        if block[i] < surge:
            i += 1
            continue
        start = i
        while i < len(block) and block[i]:
            i += 1
        heavy = [k for k in range(start, i) if weights[k]]  # lines of links alone don't begin or end a text
        kept += [t for t in texts[heavy[0]:heavy[-1] + 1] if t]
    return " ".join(kept)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` of every page with its main ``text`` and ``n_chars``."""
    frame = pages.select(*[f"`{c}`" for c in keep], F.col(html_col).alias("__html"))
    schema = StructType([*frame.schema.fields[:-1], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = pylist(b, "__html")
            for lo, hi in slices(pages, 2_000_000):
                found = [main_text(p) for p in pages[lo:hi]]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).slice(lo, hi - lo) for k in range(len(keep))), pa.array(found, pa.string()),
                     pa.array([len(t) for t in found], pa.int64())], names=[*keep, "text", "n_chars"])
    return bounded(frame).mapInArrow(run, schema)
