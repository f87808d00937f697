"""Main text of web pages as a maximum-scoring subsequence.

A page is read as a sequence of tags and words. Words score positive and tags negative; one
linear scan finds the contiguous region with the highest sum, and its blocks, without those
of boilerplate elements inside it, are the main text.

The weights come from labelled pages: those that mark their content with ``article`` or
``main``. For every kind of element (name with class or id, else name) the words inside and
outside the marked content are summed over all such pages; the log ratio is its weight. Words
under an element that belongs outside score almost nothing, and its tags cost more; a word
outweighs the tags around it, so short paragraphs at the ends of an article stay. Kinds are hashed
into ``KINDS`` bins, so the learned table is bounded. A fixed list of boilerplate names
covers elements that the pages at hand do not show.

Defined cases: a null html is empty; a page without words has an empty text; comments, raw
elements and tags that are cut off at the end of the page are dropped to its end; repeated
rows are extracted alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = 1 << 16
OUTSIDE, INSIDE = -1.5, 1.5
TAG_COST, OUTSIDE_COST, FAINT = 0.1, 0.3, 0.05
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
RAW = frozenset("script style noscript template textarea iframe title svg math object canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"option", "legend", "summary"}
CONTENT = frozenset(("article", "main"))
CONTAINERS = frozenset(("div", "section", "td"))
BOILERPLATE_TAGS = frozenset("aside button dialog footer form head header menu nav search".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner banners breadcrumb breadcrumbs "
    "captcha comment comments consent cookie cookies copyright disclaimer disqus footer gdpr header "
    "login masthead menu menus modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination paywall popup promo promoted promotion recommended related replies "
    "reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "teaser toolbar widget widgets".split())


class Element:
    """An element: its name, the bins of its kinds and whether a list calls it boilerplate.

    ``listed`` goes by any word of its class and id names, ``named`` by a whole name, its tag or its role.
    The rest is filled in while a page is read: whether it ``holds`` marked content, whether it is
    ``shown`` as an event, and what it inherits (see ``_descend``).
    """

    __slots__ = ("name", "bins", "listed", "named", "content", "container", "holds", "shown", "inside", "boilerplate",
                 "kept", "outside", "words", "holder", "top", "first")

    def __init__(self, name: str, attributes: str):
        self.name = name
        kinds, names, whole, self.content = [], set(), False, name in CONTENT
        self.container = name in CONTAINERS
        self.holds = self.shown = False
        self.named = name in BOILERPLATE_TAGS
        for match in _ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
            what, value = match[1].lower(), (match[2] or "").strip("\"'")
            if what == "hidden" or (what == "aria-hidden" and value == "true"):
                self.named = True
            elif what == "role":
                self.content |= value == "main"
                self.named |= value.lower() in BOILERPLATE_NAMES
            elif what in ("class", "id"):
                words = value.split()
                kinds += [f"{name}.{w}" if what == "class" else f"{name}#{w}" for w in words]
                for w in words:
                    whole |= w.lower() in BOILERPLATE_NAMES
                    names.update(x.lower() for x in _NAME.findall(w))
        plain = name not in ("html", "body") and not self.content
        self.named |= plain and whole
        self.listed = self.named or (plain and bool(names & BOILERPLATE_NAMES))
        self.bins = [xxhash.xxh3_64_intdigest(k) % KINDS for k in kinds or [name]]


def read_page(page: str) -> Iterator[tuple[str, object]]:
    """Events of a page: ("open", Element), ("close", Element) and ("text", str) per block,
    with the elements properly nested. Text comes decoded, before the tag that ends it."""
    stack: list[Element] = []
    open_names: Counter = Counter()
    text: list[str] = []
    at, lowered = 0, None

    def words() -> Iterator[tuple[str, str]]:
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                yield "text", joined

    def close(depth: int) -> Iterator[tuple[str, object]]:
        yield from words()
        while len(stack) > depth:
            element = stack.pop()
            open_names[element.name] -= 1
            if stack:
                stack[-1].holds |= element.holds or element.content
            if element.shown:
                yield "close", element

    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            text.append(entities.unescape(page[at:]))
            break
        if start > at:
            text.append(entities.unescape(page[at:start]))
        match = _TOKEN.match(page, start)
        if match and match[2] and match.end() == len(page) and page[-1] != ">":
            match = _LOOSE.match(page, start)  # an open quote: the tag ends at the next >
        match = match or _LOOSE.match(page, start)
        if not match:
            text.append("<")
            at = start + 1
            continue
        at = match.end()
        if not match[2]:
            continue
        name = match[2].lower()
        if match[1]:
            depth = None
            if open_names[name] > 0:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].name == name:
                        break
                    if name not in BLOCK and stack[depth].name in BLOCK:
                        depth = None  # an inline end tag closes nothing beyond its block
                        break
            if depth is not None:
                if name in BLOCK:
                    yield from close(depth)
                else:
                    for element in stack[depth:]:
                        open_names[element.name] -= 1
                        if depth:
                            stack[depth - 1].holds |= element.holds or element.content
                    shown = [x for x in stack[depth:] if x.shown]
                    del stack[depth:]
                    for element in reversed(shown):
                        yield "close", element
            elif name in BLOCK:
                yield from words()
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in RAW:
            if match[0].endswith("/>") and name in ("svg", "math"):
                continue
            lowered = page.lower() if lowered is None else lowered
            end = lowered.find("</" + name, at)
            end = len(page) if end < 0 or len(lowered) != len(page) else page.find(">", end) + 1 or len(page)
            if len(lowered) != len(page):  # lower-casing changed the length
                found = re.compile(f"</{name}[^>]*(?:>|$)", re.I).search(page, at)
                end = found.end() if found else len(page)
            at = end
            text.append(" ")
            continue
        if name in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name in BLOCK), None)
            if depth is not None and (stack[depth].name == "p" or stack[depth].name == name == "li"):
                yield from close(depth)
        if name in BLOCK:
            yield from words()
        if name in VOID:
            continue
        element = Element(name, match[3] or "")
        stack.append(element)
        open_names[name] += 1
        if name in BLOCK or element.listed:
            yield from words()
            element.shown = True
            yield "open", element
    yield from close(0)


def _descend(element: Element, above: Element | None) -> None:
    """What an element inherits: whether its path lies in marked content (``inside``) and in listed boilerplate.

    An element that holds marked content is boilerplate only if it is named so, not for a word
    in a longer name (``has-sidebar``, ``comments-closed``); a header within content is none.
    """
    inside = above is not None and above.inside
    own = (element.named if element.holds else element.listed) and not (inside and element.name in ("header", "hgroup"))
    element.boilerplate = own or (above is not None and above.boilerplate)
    element.inside = inside or element.content


def _walk(events: list[tuple[str, object]]) -> Iterator[tuple[str, object, Element | None]]:
    """Events of a whole page with the innermost shown element around them; each element
    inherits from the one above it when it opens, so a step costs the same at any depth."""
    path: list[Element] = []
    for kind, what in events:
        if kind == "close":
            path.pop()
        yield kind, what, path[-1] if path else None
        if kind == "open":
            path.append(what)


def count_kinds(page: str, inner: np.ndarray, outer: np.ndarray) -> None:
    """Add the words of a labelled page to bins: words of the content to all elements from the
    marked one down (a bin once per word), others to the highest element above them that holds no content."""
    events = list(read_page(page))
    any_content = False
    for kind, what, above in _walk(events):
        if kind == "open":
            _descend(what, above)
            what.words, what.holder = 0, False
        elif kind == "text" and above is not None and above.inside and not above.boilerplate:
            above.words += what.count(" ") + 1
            above.holder = any_content = True
        elif kind == "close" and above is not None:
            above.words += what.words
            above.holder |= what.holder
    if not any_content:
        return
    on_path: Counter = Counter()
    for kind, what, above in _walk(events):
        if kind == "open":
            what.top = above.top if above is not None and above.top is not None else None if what.holder else what
            what.first = [b for b in set(what.bins) if what.inside and not on_path[b]]
            on_path.update(what.first)
            inner[what.first] += what.words
        elif kind == "close":
            on_path.subtract(what.first)
        elif above is not None and not (above.inside and not above.boilerplate) and above.top is not None:
            outer[list(set(above.top.bins))] += what.count(" ") + 1


def learn(pages: DataFrame) -> np.ndarray:
    """Weight of each bin from all labelled pages: the log ratio of words inside and outside."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inner, outer = np.zeros(KINDS, np.int64), np.zeros(KINDS, np.int64)
        for batch in batches:
            for page in batch["html"]:
                count_kinds(page or "", inner, outer)
        some = np.flatnonzero(inner + outer)
        yield pd.DataFrame({"bin": some.astype(np.int32), "inner": inner[some], "outer": outer[some]})

    sums = (pages.select("html").mapInPandas(count, "bin int, inner long, outer long")
            .groupBy("bin").agg(F.sum("inner").alias("inner"), F.sum("outer").alias("outer")).toPandas())
    weights = np.zeros(KINDS, np.float32)
    if len(sums):
        ratio = np.log((sums["inner"].to_numpy(float) + 1) / (sums["outer"].to_numpy(float) + 1))
        weights[sums["bin"].to_numpy()] = ratio
    return weights


def extract(page: str | None, weights: np.ndarray) -> str:
    """Main text of one page: the blocks of the best region, joined by line ends."""
    best, best_span = 0.0, (0, 0)
    total, first = 0.0, 0
    kept: list[str | None] = []
    for kind, what, above in _walk(list(read_page(page or ""))):
        content = above is not None and above.kept
        if kind == "text":
            outside = above is not None and (above.boilerplate or above.outside)
            gain = (what.count(" ") + 1) * (FAINT if outside else 1.0) * (0.0 if outside and content else 1.0)
            if total <= 0:
                total, first = 0.0, len(kept)
            total += gain
            kept.append(None if outside else what)
            if total > best:
                best, best_span = total, (first, len(kept))
            continue
        away = _learned_outside(what, weights)
        if kind == "open":
            _descend(what, above)
            what.kept = content or what.content or (what.container and min(weights[b] for b in what.bins) > INSIDE)
            what.outside = away or (above is not None and above.outside)
        listed = what.named if what.holds else what.listed
        total -= OUTSIDE_COST if not content and (listed or away) else TAG_COST
    return "\n".join(x for x in kept[slice(*best_span)] if x is not None)


def _learned_outside(element: Element, weights: np.ndarray) -> bool:
    """Whether some kind of the element is learned to lie outside content."""
    return not element.content and min(weights[b] for b in element.bins) < OUTSIDE


def extract_pages(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(learn(pages) if weights is None else weights)

    def run(batches):
        for batch in batches:
            own = shared.value
            texts = [extract(x, own) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"),
                         F.col("html").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
