"""Main text of web pages as the maximum-scoring run of tokens.

A page becomes a sequence of words and tags. Words score by the element that they stand in,
tags cost; a linear scan finds the contiguous region of highest sum, which is the content. The
scores are log odds counted on labelled pages: those whose mark-up names its article say which
tokens lie inside it and which do not. Elements that are never content (menus, adverts, forms,
scripts, comments of readers) are left out of the region too.

Cases: a null html counts as empty and gives an empty text, as does a page without words.
Broken mark-up (open elements, an end inside a tag) is read as far as it goes. Ties go to the
longer region, then to the earlier one. Very long pages are read whole. Repeated rows each get
a result. Without labelled pages, fixed scores apply: words 1, tags -3. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import map_with_id, quoted

MOST_LABELLED = 2_000
MOST_WRAPPERS = 8
LEAST_COST = -0.1

# What HTML says about its elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
NEVER = frozenset(
    "script style noscript template svg math iframe object canvas audio video map head title "
    "nav header footer aside form button select textarea fieldset label dialog menu".split()
)
SELF_CLOSING = frozenset("li dt dd tr td th option p".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe")
# Classes and ids that mark an element as no content.
NEVER_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside "
    "widget notice cookie cookies consent popup modal newsletter subscribe signup login share "
    "sharing social related recommended comment comments disqus replies reply toolbar pager "
    "pagination".split()
)
CONTENT_ROOTS = ("article", "main")
NEVER_BY_NAME = frozenset(("html", "body", *CONTENT_ROOTS))  # their names say nothing

# States of a page or an element, and what only says that another part is there or not.
STATES = frozenset("with has no without is show hide open closed enabled disabled on off".split())
# Parts of longer names that tell no content: as the first part, as the last, or as both.
NEVER_FIRST = frozenset(
    "comment comments disqus cookie cookies consent gdpr sidebar ad ads advert advertisement "
    "sponsor sponsored promo newsletter related share sharing social nav menu breadcrumb "
    "breadcrumbs pagination popup modal subscribe".split()
)
NEVER_LAST = frozenset("sidebar comments ads advert advertisement menu nav navbar navigation".split())
# What readers write is never the page's content, however long it is.
READERS = frozenset("comment comments disqus replies reply".split())
SITE_PARTS = (frozenset("site page global top bottom main".split()), frozenset("header footer".split()))

# In a tag only a quote after an equals sign opens a value, in which the tag does not end.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*(?:>|$)"
    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*)(?:>|$)|[^<]+|<""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.DOTALL
)
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in RAW}


@dataclass
class Token:
    """A run of text in one element, or a tag."""

    kind: str  # what its score depends on
    words: int = 0
    text: str = ""
    block: bool = False  # text before and after belongs to different blocks
    dropped: bool = False  # inside an element that is never content
    rooted: bool = False  # inside the element marked as the content


def _no_content(name: str) -> bool:
    """Whether a class or id names a part of a page that is no content.

    ``comment-list`` and ``leftSidebar`` do, ``with-sidebar`` and ``comments-open`` do not.
    """
    if name.lower() in NEVER_NAMED:
        return True
    parts = [part.lower() for part in _NAME_PARTS.findall(name)]
    if len(parts) < 2 or not STATES.isdisjoint(parts):
        return False
    if parts[0] in SITE_PARTS[0] and parts[-1] in SITE_PARTS[1]:
        return True
    return parts[0] in NEVER_FIRST or parts[-1] in NEVER_LAST


def _dropping_names(attributes: str) -> list[str]:
    """The classes and the id of a tag that drop its element."""
    lower = attributes.lower()
    if "class" not in lower and "id" not in lower:
        return []
    return [
        name
        for attribute, *values in _ATTRIBUTE.findall(attributes)
        if attribute.lower() in ("class", "id")
        for name in "".join(values).split()
        if _no_content(name)
    ]


def _of_readers(name: str) -> bool:
    return not READERS.isdisjoint(part.lower() for part in _NAME_PARTS.findall(name))


@dataclass
class _Named:
    """An element that its name drops: where it begins, what it holds, its words."""

    begin: int
    wrapper: bool  # outermost, and by its name it may be around the content
    article: bool = False
    main: bool = False
    words: int = 0


@dataclass
class _Open:
    """An open element: never content, never whatever names say, in the marked content."""

    name: str
    never: bool = False
    hard: bool = False
    rooted: bool = False
    named: _Named | None = None


class _Reader:
    """One pass over a page. Every look-up among open elements is a step, or closes elements."""

    def __init__(self, page: str, holders: frozenset[int]) -> None:
        self.result: list[Token] = []
        self.named: list[_Named] = []  # all that were met
        self.roots = 0
        self.bare_roots = 0  # marked content that no dropped element is around
        self.left = 0  # words that are not dropped
        self._stack = [_Open("")]
        self._count: dict[str, int] = {}
        self._blocks: list[int] = []  # places of open blocks
        self._dropping: list[_Named] = []  # open ones of ``named``
        self._read(page, holders)
        self._close(1)

    def _close(self, depth: int) -> None:
        """Close the open elements from a place on."""
        while len(self._stack) > depth:
            element = self._stack.pop()
            self._count[element.name] -= 1
            if self._blocks and self._blocks[-1] == len(self._stack):
                self._blocks.pop()
            if element.named is not None:
                self._dropping.pop()
                if self._dropping:
                    # What an element holds, the one around it holds.
                    around = self._dropping[-1]
                    around.article |= element.named.article
                    around.main |= element.named.main
                    around.words += element.named.words

    def _text(self, whole: str) -> None:
        inner = self._stack[-1]
        text = entities.unescape(whole)
        parent = self._stack[self._blocks[-1]].name if self._blocks else ""
        kind = "word in " + ("nothing" if inner.never else parent)
        words = len(text.split())
        self.result.append(Token(kind, words, text, False, inner.never, inner.rooted))
        if not inner.never:
            self.left += words
        elif not inner.hard and self._dropping:
            self._dropping[-1].words += words

    def _end(self, name: str, block: bool) -> None:
        before = self._stack[-1]
        if self._count.get(name):
            depth = len(self._stack) - 1
            while self._stack[depth].name != name:
                depth -= 1
            self._close(depth)
        tag = Token("/" + name, block=block, dropped=before.never, rooted=before.rooted)
        self.result.append(tag)

    def _open(
        self, name: str, block: bool, attributes: str, begin: int, drops: list[str]
    ) -> None:
        inner = self._stack[-1]
        opening = Token(name, block=block, dropped=inner.never, rooted=inner.rooted)
        self.result.append(opening)
        if name in VOID or attributes.endswith("/"):
            return
        # A block ends an open paragraph; an item or cell ends the one before it.
        if block and self._blocks:
            parent = self._stack[self._blocks[-1]].name
            if parent == "p" or (parent == name and name in SELF_CLOSING):
                self._close(self._blocks[-1])
                inner = self._stack[-1]
        if name in CONTENT_ROOTS:
            self.roots += 1
            if self._dropping:
                self._dropping[-1].main |= name == "main"
                self._dropping[-1].article |= name == "article"
            else:
                self.bare_roots += 1
        hard = inner.hard or name in NEVER
        element = _Open(
            name,
            inner.never or hard or bool(drops),
            hard,
            inner.rooted or name in CONTENT_ROOTS,
        )
        if drops:
            outermost = not self._dropping and not hard
            element.named = _Named(begin, outermost and not any(map(_of_readers, drops)))
            self.named.append(element.named)
            self._dropping.append(element.named)
        opening.dropped = element.never
        if block:
            self._blocks.append(len(self._stack))
        self._count[name] = self._count.get(name, 0) + 1
        self._stack.append(element)

    def _read(self, page: str, holders: frozenset[int]) -> None:
        at = 0
        while at < len(page):
            match = _TOKEN.match(page, at)
            begin, at = at, match.end()
            whole, name = match.group(), (match.group(2) or "").lower()
            if not name:
                if not whole.startswith(("<!", "<?")):
                    self._text(whole)
                continue
            block = name not in INLINE
            if match.group(1):
                self._end(name, block)
                continue
            named = name not in NEVER_BY_NAME and begin not in holders
            drops = _dropping_names(match.group(3)) if named else []
            opened = len(self._stack)
            self._open(name, block, match.group(3), begin, drops)
            if name in _RAW_END and len(self._stack) >= opened and self._stack[-1].name == name:
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else len(page)


def tokens(page: str) -> list[Token]:
    """Words and tags of a page.

    An element with a name of no content is content all the same if the page's content is in
    it. Comments may be articles too, so such an element around an article counts only on
    pages without one outside; it always counts around a main element. On a page that marks
    no content, it is a wrapper that has ten times the words of all that is not dropped; there
    may be some wrappers around each other.
    """
    read = _Reader(page, frozenset())
    if read.roots:
        holders = {e.begin for e in read.named if e.main or (e.article and not read.bare_roots)}
        return _Reader(page, frozenset(holders)).result if holders else read.result
    holders = set()
    for _ in range(MOST_WRAPPERS):
        wrappers = [e for e in read.named if e.wrapper and e.words > 10 * read.left]
        if not wrappers:
            break
        holders.add(max(wrappers, key=lambda e: e.words).begin)
        read = _Reader(page, frozenset(holders))
    return read.result


@dataclass(frozen=True)
class Scores:
    """Score of a word or tag of each kind; the two constants are for kinds not seen."""

    of: dict[str, float] = field(default_factory=dict)
    word: float = 1.0
    tag: float = -3.0

    def __call__(self, token: Token) -> float:
        if token.dropped:
            # Words outside all content count against a region that spans them, but the
            # adverts and forms in the midst of it do not cut it.
            return 0.0 if token.rooted else -1.0 * token.words
        if token.words:
            return self.of.get(token.kind, self.word) * token.words
        if token.text:
            return 0.0
        return self.of.get(token.kind, self.tag)


def best_region(values: np.ndarray) -> tuple[int, int]:
    """Begin and end of the contiguous run of highest sum; (0, 0) if none is above zero.

    One pass over running sums: a run's sum is the sum at its end less the lowest before it.
    """
    sums = np.concatenate([[0.0], np.cumsum(values)])
    lowest = np.minimum.accumulate(sums)
    gain = sums - lowest
    top = gain.max()
    if top <= 1e-9:
        return 0, 0
    ends = np.flatnonzero(gain >= top - 1e-9)
    # The first place of the lowest sum before each end gives the longest run.
    begins = np.searchsorted(-lowest, -lowest[ends] - 1e-9)
    longest = int(np.argmax(ends - begins))
    return int(begins[longest]), int(ends[longest])


def region_text(region: list[Token]) -> str:
    """Words of the region: one space for white space and between blocks."""
    parts = [
        " " if t.block else "" if t.dropped else t.text for t in region
    ]
    return " ".join("".join(parts).split())


def main_text(page: str | None, scores: Scores) -> str:
    found = tokens(page or "")
    if not found:
        return ""
    begin, end = best_region(np.array([scores(t) for t in found]))
    return region_text(found[begin:end])


def learn_scores(pages: list[str | None]) -> Scores:
    """Log odds of being inside the marked content, from pages that mark it once."""
    inside: dict[str, float] = {}
    outside: dict[str, float] = {}
    for page in pages:
        found = tokens(page or "")
        if sum(t.kind in CONTENT_ROOTS for t in found) != 1:
            continue
        for token in found:
            if token.dropped and not token.text:
                # Tags in menus tell nothing of the same tags elsewhere.
                continue
            side = inside if token.rooted and not token.dropped else outside
            weight = token.words if token.text else 1
            side[token.kind] = side.get(token.kind, 0.0) + weight
    if not inside:
        return Scores()
    of = {}
    for kind in inside.keys() | outside.keys():
        odds = np.log((inside.get(kind, 0.0) + 0.5) / (outside.get(kind, 0.0) + 0.5))
        if kind.startswith("word in "):
            of[kind] = float(np.clip(odds, -3.0, 3.0))
        else:
            # Tags cost in any case; those that content hardly has cost most.
            of[kind] = float(np.clip(odds - 3.0, -3.0, LEAST_COST))
    for root in CONTENT_ROOTS:
        # The marks themselves are no evidence.
        of.pop(root, None)
        of.pop("/" + root, None)
    # A tag that no labelled page has, other than in menus, is evidence of nothing.
    return Scores(of, tag=LEAST_COST)


def train(
    pages: DataFrame,
    html: str = "html",
    page_id: str = "page_id",
    most_labelled: int = MOST_LABELLED,
) -> Scores:
    """Scores from at most so many labelled pages, those whose ids hash lowest."""
    marked = F.lower(quoted(html)).rlike("<(article|main)[\\s>]")
    rows = pages.filter(marked).select(
        F.xxhash64(quoted(page_id)).alias("_order"), quoted(page_id).alias("_id")
    )
    chosen = rows.distinct().orderBy("_order", "_id").limit(most_labelled)
    # Bounded by the sample size; a repeated id gives its smallest page.
    sample = pages.select(quoted(page_id).alias("_id"), quoted(html).alias("_html"))
    sample = sample.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_html").alias("html"))
    return learn_scores(list(sample.toPandas().sort_values("_id")["html"]))


def extract(
    pages: DataFrame, scores: Scores, html: str = "html", page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """Main text of each page."""
    rows = pages.select(
        quoted(page_id).alias("page_id"), quoted(url).alias("url"), quoted(html).alias("html")
    )

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            result = batch[["page_id", "url"]].copy()
            result["text"] = [main_text(page, scores) for page in batch["html"]]
            yield result

    result = map_with_id(rows, extracted, "text string", ("page_id", "url"))
    return result.withColumn("n_chars", F.length("text").cast("long"))
