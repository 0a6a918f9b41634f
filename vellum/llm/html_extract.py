"""Main text of web pages by a maximum-scoring subsequence of page tokens.

A page is a sequence of tokens: words and tags. Words score positive, tags
negative; the contiguous run of tokens with the largest sum is the content
region, found in one linear scan. The weights come from labelled pages: those
that mark their article themselves (one <article> or <main>). On a bounded
sample of them, every kind of tag and every place of a word (the block it is
in, with its class; links apart) is counted inside and outside the article,
and the log odds become the weights. The marking elements themselves carry no
weight, so the scan works alike on pages without them.

Elements whose tag, role or hiding attribute says that they aren't part of the
article (menus, forms and the like) are left out of the region's text, wherever
they stand. A class or id only speaks against an element: one that holds most of
the article's words (those of the marked article, or of the page where nothing
is marked) is a wrapper, and its name means nothing. Of the others, adverts,
comments and elements named in whole ("sidebar") are left out, and those that
only have such a word in a longer name ("share-prices") are left out if they hold
little running text, and otherwise cost a fixed sum in the scan.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.text import python_workers_import

# HTML's elements by kind (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title textarea select option button iframe object svg math "
                   "canvas audio video map datalist".split())
APART = frozenset("nav aside footer form dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp "
                   "small span strike strong sub sup time tt u var wbr br input".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figure figcaption".split())
MARKS = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: parts of class and id names that stand for something else than the article
WORDS_APART = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments reply replies respond disqus discussion pagination pager widget widgets "
    "skip hidden copyright legal search form".split())
#: those of them that leave an element out as a part of a longer name too
WORDS_SURE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr newsletter "
    "comment comments reply replies respond disqus".split())
#: those of them that name blocks of articles too, so that inside of a mark they are taken as parts of longer names are
WORDS_UNSURE = frozenset("alert banner copyright discussion foot footer form head header legal notice notices search share".split())
#: words outside of links from which an element with a doubtful name has running text, and what it costs in the scan
LEAST_PROSE, NAME_COST = 15, 5.0
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(frozen=True)
class Weights:
    """``tags``: weight of a tag by its kind; ``words``: weight of a word by its place."""

    tags: dict[str, float] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)

    def tag(self, kinds: tuple[str, ...]) -> float:
        """The learned weight, or for a tag never learned one by its kind."""
        usual = -0.1 if kinds[0] in INLINE else -0.3 if kinds[0] in TEXT_BLOCKS else -1.5
        return min((self.tags[k] for k in kinds if k in self.tags), default=usual)

    def word(self, kinds: tuple[str, ...]) -> float:
        return min((self.words[k] for k in kinds if k in self.words), default=0.05 if kinds == ("a",) else 0.7)


def _says_apart(tag: str, attrs: list[tuple[str, str | None]], inside_mark: bool) -> bool:
    if tag in APART or (tag == "header" and not inside_mark):
        return True
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in ROLES:
            return True
    return False


@dataclass(frozen=True)
class Named:
    """An element whose class or id speaks against it: whether for sure, and
    whether it is an <article> that is another thing than the page's."""

    sure: bool
    other: bool


def _named(tag: str, attrs: list[tuple[str, str | None]], inside_mark: bool) -> Named | None:
    if tag in ("body", "html", "main"):
        return None
    found = None
    for name in (x for n, v in attrs if n in ("class", "id") and v for x in v.split()):
        parts = [w.lower() for w in _NAME.findall(name)]
        if tag == "article":
            against = {"comment", "reply", "ad", "promo", "related"}.intersection(parts)
            if against:
                found = Named(True, bool(against & {"comment", "reply"}) or len(parts) == 1 or bool(found and found.other))
            continue
        against = WORDS_APART.intersection(parts)
        if not against:
            continue
        whole = len(against) == len(set(parts)) and not (inside_mark and against <= WORDS_UNSURE)
        if whole or against & WORDS_SURE:
            return Named(True, False)
        found = Named(False, False)
    return found


class Page(HTMLParser):
    """The tokens of a page: (kinds, text, block, apart, in article, cost)."""

    def __init__(self, html: str, forms_apart: bool = True):
        super().__init__(convert_charrefs=True)
        self.forms_apart = forms_apart
        self.open: list[tuple[str, tuple[str, ...], bool, bool, int]] = []  # name, kinds, apart, unseen, scope
        self.block, self.marked, self.n_marks = 0, 0, 0
        self.marks: Counter = Counter()  # open marks by tag
        self.scopes: list[tuple[int, Named | None]] = [(0, None)]  # the named elements, each with the scope around it
        self._found: list[tuple[tuple[str, ...], str | None, int, bool, bool, str, int, bool]] = []
        self.feed(html)
        self.close()
        self.tokens = self._weighed()

    def _weighed(self) -> list[tuple[tuple[str, ...], str | None, int, bool, bool, float]]:
        """The tokens, with the named elements judged by what they hold."""
        in_other = [False] * len(self.scopes)
        for i, (around, named) in enumerate(self.scopes[1:], 1):
            in_other[i] = in_other[around] or named.other
        # what each scope itself holds: words of marked articles, of <main>, of the page, outside of links, in links
        own = [[0.0, 0.0, 0.0, 0, 0] for _ in self.scopes]
        for kinds, text, _, apart, _, mark, scope, _ in self._found:
            if text is None or apart:
                continue
            n, mine = len(text.split()), own[scope]
            value = n * (0.05 if kinds == ("a",) else 1.0)
            if mark and not in_other[scope]:
                mine[0 if mark == "article" else 1] += value
            mine[2] += value
            mine[4 if kinds == ("a",) else 3] += n
        for i in range(len(self.scopes) - 1, 0, -1):  # a scope's number is above that of the one around it
            around = own[self.scopes[i][0]]
            for k, x in enumerate(own[i]):
                around[k] += x
        of = next((k for k in (0, 1, 2) if own[0][k] > 0), 2)
        out, cost = [False] * len(self.scopes), [0.0] * len(self.scopes)
        for i, (around, named) in enumerate(self.scopes[1:], 1):
            wrapper = 2 * own[i][of] > own[0][of]
            little = own[i][3] < LEAST_PROSE or 2 * own[i][4] > own[i][3]
            out[i] = out[around] or (not wrapper and (named.sure or little))
            cost[i] = 0.0 if wrapper else NAME_COST
        return [(kinds, text, block, apart or out[scope], inside, cost[scope] if opens else 0.0)
                for kinds, text, block, apart, inside, _, scope, opens in self._found]

    def _add(self, kinds: tuple[str, ...], text: str | None, apart: bool, scope: int, opens: bool = False) -> None:
        mark = "article" if self.marks["article"] > 0 else "main" if self.marked > 0 else ""
        self._found.append((kinds, text, self.block, apart, self.marked > 0, mark, scope, opens))

    def _kinds(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[str, ...]:
        names = next((v for n, v in attrs if n == "class" and v), None) or next((v for n, v in attrs if n == "id" and v), "")
        return (tag, *(f"{tag}.{w}" for w in names.split()[:3]))

    def _tag(self, kinds: tuple[str, ...], apart: bool, scope: int, opens: bool = False) -> None:
        if kinds[0] not in INLINE:
            self.block += 1
        if kinds[0] not in MARKS:
            self._add(kinds, None, apart, scope, opens)

    def _close_to(self, at: int) -> None:
        closed = [x[0] for x in self.open[at:] if x[0] in MARKS]
        self.marked -= len(closed)
        self.marks.subtract(closed)
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" and any(x[0] == "head" for x in self.open):
            self._close_to(next(i for i, x in enumerate(self.open) if x[0] == "head"))
        if tag not in INLINE:  # a block ends an open paragraph; an item ends the one before it
            ends = {"li": ("p", "li"), "dd": ("p", "dd", "dt"), "dt": ("p", "dd", "dt"), "tr": ("p", "td", "th", "tr"),
                    "td": ("p", "td", "th"), "th": ("p", "td", "th")}.get(tag, ("p",))
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name in ends:
                    self._close_to(i)
                elif name not in INLINE and name not in ("p", "li", "dd", "dt", "td", "th"):
                    break
        kinds = self._kinds(tag, attrs)
        apart = bool(self.open and self.open[-1][2]) or (
            (self.forms_apart or tag != "form") and _says_apart(tag, attrs, self.marked > 0))
        unseen = tag in UNSEEN or bool(self.open and self.open[-1][3])
        scope = self.open[-1][4] if self.open else 0
        named = None if apart or unseen or tag in VOID else _named(tag, attrs, self.marked > 0)
        if named:
            self.scopes.append((scope, named))
            scope = len(self.scopes) - 1
        if not unseen:
            self._tag(kinds, apart, scope, named is not None)
        if tag == "br":
            self._add(("br",), " ", apart, scope)
        if tag not in VOID:
            self.open.append((tag, kinds, apart, unseen, scope))
            if tag in MARKS:
                self.marks[tag] += 1
                self.marked += 1
                self.n_marks += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do: the slash means nothing but on void elements

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is None:
            return
        if tag in INLINE and any(x[0] not in INLINE for x in self.open[at:]):
            return
        _, kinds, apart, unseen, scope = self.open[at]
        if not unseen:
            self._tag(kinds, apart, scope)
        self._close_to(at)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][3]:
            return
        place = ("a",) if any(x[0] == "a" for x in self.open) else next(
            (x[1] for x in reversed(self.open) if x[0] not in INLINE and x[0] not in MARKS), ("body",))
        self._add(place, data, bool(self.open and self.open[-1][2]), self.open[-1][4] if self.open else 0)

    def unknown_decl(self, data: str) -> None:
        """<![...]> sections are markup."""


def count_places(html: str | None) -> Counter:
    """(kind of thing, kind, inside) → count, for a page that marks its one
    article; nothing for others."""
    page = Page(html or "")
    out: Counter = Counter()
    if page.n_marks != 1:
        return out
    for kinds, text, _, apart, inside, _ in page.tokens:
        if apart:  # left out by name: teaches nothing about other places
            continue
        n = 1 if text is None else len(text.split())
        for k in kinds:
            out["tag" if text is None else "word", k, inside] += n
    return out


def weights_from(counts: dict[tuple[str, str, bool], int], least: int = 5) -> Weights:
    """Weights by log odds; kinds seen less than ``least`` times get none."""
    out = Weights()
    for what, kind in {(w, k) for w, k, _ in counts}:
        inside, outside = counts.get((what, kind, True), 0), counts.get((what, kind, False), 0)
        if inside + outside < least:
            continue
        if what == "tag":
            out.tags[kind] = -max(0.1, min(8.0, 1.0 + math.log((outside + 1) / (inside + 1))))
        else:
            out.words[kind] = max(0.02, (inside + 0.5) / (inside + outside + 1))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """(from, to) of the contiguous run with the largest positive sum (the
    first one of equal sums, and the shortest of those); (0, 0) if none."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best + 1e-12:
            best, span = total, (start, i + 1)
    return span


def main_text(html: str | None, weights: Weights) -> str:
    """The main text: blocks joined by one line break."""
    if not html:
        return ""
    for forms_apart in (True, False):  # some pages are one large form
        tokens = Page(html, forms_apart).tokens
        # what is left out anyway costs little, so it doesn't part the article
        start, end = best_run([(-0.1 if apart else weights.tag(kinds) - cost) if text is None else
                               0.0 if apart else weights.word(kinds) * len(text.split())
                               for kinds, text, _, apart, _, cost in tokens])
        blocks: dict[int, list[str]] = {}
        for _, text, block, apart, _, _ in tokens[start:end]:
            if text is not None and not apart:
                blocks.setdefault(block, []).append(text)
        lines = [" ".join("".join(parts).split()) for parts in blocks.values()]
        found = "\n".join(x for x in lines if x)
        if found:
            return found
    return ""


def fit_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 500) -> Weights:
    """Weights from at most ``max_pages`` labelled pages (those with the least
    hashed ids among the pages that mark an article); the bound keeps the
    counts that reach the driver small."""
    python_workers_import(pages.sparkSession)
    labelled = pages.where(F.lower(html_col).rlike(r"<(article|main)[\s>]"))
    chosen = (labelled.select(F.xxhash64(id_col).alias("_h")).distinct().orderBy("_h").limit(max_pages))
    sample = labelled.join(F.broadcast(chosen), F.xxhash64(id_col) == F.col("_h"), "left_semi").select(html_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column(0).to_pylist():
                total += count_places(html)
        keys = list(total)
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
            pa.array([k[2] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
            names=["what", "kind", "inside", "n"])

    rows = (sample.mapInArrow(count, "what string, kind string, inside boolean, n long")
            .groupBy("what", "kind", "inside").agg(F.sum("n").alias("n")).collect())
    return weights_from({(r.what, r.kind, r.inside): r.n for r in rows})


def extract_pages(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """One row per input row: ``page`` (the input row without its html, as a
    struct) and ``text``.

    Edge cases: a NULL or empty page, and one without words, has the empty
    text; broken markup is read as browsers do, roughly; repeated rows give
    equal results; an empty table gives an empty result. A map over the scan:
    no shuffle.
    """
    python_workers_import(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield htmls.map(lambda h: main_text(h, weights), na_action=None)

    others = [c for c in pages.columns if c != html_col]
    return pages.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("page"), extract(F.col(html_col)).alias("text"))
