"""HTML extraction: the main text of a page from a stream of parser events.

The standard library's parser emits events; block-level tags cut them into lines, each
with its text, the tags within it and the element that holds it.  A line's text-to-tag ratio,
smoothed over its neighbours by a Gaussian, is its score.  Names of elements and classes only weigh it:
menus, forms, adverts, comments and the like count little or nothing, and so does what lies
outside the articles of a page that has some; a form or class that wraps the content does not count as one.
The threshold is half the mean score.  Lines give their element what they
have above it, or take from it what they lack; the container with the greatest sum is the content
region, widened to the article or main part it lies in.  All its lines are kept, short ones too, but for
boilerplate elements within it whose sum is below zero, and, where the region is the whole page, other
containers with such a sum; what holds a first heading stays.

Null and empty html give an empty text.  Each row is read on its own, so repeated rows
and ids change nothing; an empty table gives an empty result.  A page of any length and depth is read whole,
in time and memory in proportion to it.  End tags that HTML lets one omit need not be there.  Other columns pass
through, but for one named ``text``, which is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickshop.llm.common import field, mapped, others, prepare

# Elements by what the HTML standard says of them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu"
    " nav ol p pre section summary table tbody td tfoot th thead tr ul head title".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNSEEN = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map math".split()
)
CHROME = frozenset(
    "nav footer aside form menu dialog button select textarea input option fieldset label".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
# Words of class and id names that mark parts around the article.
MARKS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside notice cookie cookies"
    " consent gdpr banner ad ads advert adverts advertisement advertising sponsor sponsored promo"
    " comment comments disqus reply replies share sharing social related recommended breadcrumb"
    " breadcrumbs newsletter subscribe signup login popup modal overlay pagination pager toolbar"
    " widget search copyright skip alert".split()
)
# Words beside a mark that leave it one; any other word makes it a name of its own.
PLAIN = frozenset(
    "area bar block bottom box button buttons col container content entry fixed global group inner item items"
    " left link links list main outer page panel post primary right row secondary section site sticky text"
    " top wrap wrapper".split()
)
# Marks of parts with text of their own, which may be longer than the article.
OTHERS_TEXT = frozenset("comment comments disqus reply replies related recommended".split())
HOLDERS = frozenset("article main".split())
PAGE = frozenset(["", "html", "body"])
# Blocks that hold a text but no content region.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 hr li dt dd pre blockquote caption figcaption summary legend address".split())
# What may stand in a head; anything else ends one that is open.
HEAD = frozenset("title meta link style script noscript base template".split())
# Why an element counts little: nothing, a form, a class name, a class name of other texts,
# or for certain.
NONE, FORM, CLASS, OTHER, SURE = range(5)
WEIGHTS = {NONE: 1.0, FORM: 0.02, CLASS: 0.02, OTHER: 0.0, SURE: 0.0}
BESIDE_ARTICLE = 0.02
#: Elements that an opening tag of the key closes, up to the nearest holder.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tbody": ("tr", "td", "th", "tbody", "thead"),
    "tfoot": ("tr", "td", "th", "tbody", "thead"),
    "option": ("option",),
}
SIGMA = 1.0


class _Element:
    __slots__ = ("tag", "parent", "mark", "article", "chars", "sum", "weight", "holds", "title", "wraps", "cut", "inside")

    def __init__(self, tag: str, parent: _Element | None, mark: int) -> None:
        self.tag = tag
        self.parent = parent
        self.mark = mark
        #: The nearest article or main part around, itself included.
        self.article: _Element | None = self if tag in HOLDERS else parent and parent.article
        self.chars = 0  # of lines within
        self.sum = 0.0  # of what lines within have above the threshold
        self.holds: set[str] = set()  # articles and main parts within
        self.title = False  # a first heading within
        self.wraps = self.cut = self.inside = False
        self.weight = 1.0


class _Line:
    __slots__ = ("text", "tags", "holder")

    def __init__(self, text: str, tags: int, holder: _Element) -> None:
        self.text = text
        self.tags = tags
        self.holder = holder


def _words_of(name: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in name.lower()).split()


class _Lines(HTMLParser):
    """Cuts the event stream into lines and keeps the elements, parents first."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = _Element("", None, NONE)
        self.elements = [self.top]
        self.lines: list[_Line] = []
        self._open = [Counter()]  # tags open below each article, so that an end tag is found at once
        self._parts: list[str] = []
        self._tags = 0
        self._unseen = 0

    def flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.lines.append(_Line(text, self._tags, self.top))
        self._parts, self._tags = [], 0

    def _mark(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in CHROME and tag != "form":
            return SURE
        in_article = self.top.article is not None
        if tag == "header" and not in_article:
            return SURE
        if tag in HOLDERS or tag in ("html", "body"):
            return NONE
        mark = FORM if tag == "form" else NONE
        for name, value in attrs:
            if name == "role" and value and value.lower() in ROLES:
                mark = max(mark, FORM if (tag, value.lower()) == ("form", "form") else SURE)
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return SURE
            if name in ("class", "id") and value:
                for part in value.split():
                    words = set(_words_of(part))
                    if words & MARKS and words <= MARKS | PLAIN and not (in_article and "header" in words):
                        mark = max(mark, OTHER if words & OTHERS_TEXT else CLASS)
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return SURE
        return mark

    def _push(self, tag: str, mark: int) -> None:
        self.top = _Element(tag, self.top, mark)
        self.elements.append(self.top)
        self._open[-1][tag] += 1
        if tag in HOLDERS:
            self._open.append(Counter())

    def _pop(self) -> _Element:
        closed = self.top
        self.top = closed.parent or closed
        if closed.tag in HOLDERS:
            self._open.pop()
        self._open[-1][closed.tag] -= 1
        if closed.tag in UNSEEN:
            self._unseen -= 1
        return closed

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.top.tag == "head" and tag not in HEAD:
            self._pop()
        if tag in BLOCKS:
            self.flush()
            if self.top.tag == "p":  # a block ends an open paragraph
                self._pop()
            while self.top.tag in CLOSES.get(tag, ()):
                self._pop()
        else:
            self._tags += 1
        if tag == "br":
            self._parts.append(" ")
        if tag in VOID:
            return
        if tag in UNSEEN:
            self._unseen += 1
            self._push(tag, SURE)
        elif (mark := self._mark(tag, attrs)) or tag in BLOCKS:
            if tag not in BLOCKS:
                self.flush()
            self._push(tag, mark)
            self.top.title = tag == "h1"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag in BLOCKS:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        # An end tag inside an article never closes what lies outside it, but for the page's own.
        scopes = self._open if tag in PAGE else self._open[-1:]
        closes = tag in HOLDERS and len(self._open) > 1 and self.top.article.tag == tag or any(x[tag] for x in scopes)
        if tag in BLOCKS or closes:
            self.flush()
        if closes:
            while self._pop().tag != tag:
                pass
        elif tag not in BLOCKS:
            self._tags += 1

    def handle_data(self, data: str) -> None:
        if self.top.tag == "head" and not data.isspace():
            self._pop()
        if not self._unseen:
            self._parts.append(data)


def _smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    reach = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    around = np.convolve(np.ones(len(values)), kernel)[reach:-reach]
    return (np.convolve(values, kernel)[reach:-reach] / around).tolist()


def _weigh(elements: list[_Element], lines: list[_Line]) -> None:
    """Each element's weight, from its mark and those around it.

    A mark for a form or a class name does not count if the element wraps the content: around an
    article or, for a class, a main part, or around more than half of its article's text, or of
    the page's where it has no article.
    """
    total = 0
    for line in lines:
        line.holder.chars += len(line.text)
        total += len(line.text)
    for e in reversed(elements):
        if (up := e.parent) is not None:
            up.chars += e.chars if e.mark < OTHER else 0
            up.holds |= e.holds | ({e.tag} & HOLDERS if e.chars else set())
            up.title |= e.title
    has_article = bool(elements[0].holds)
    for e in elements:
        up = e.parent
        if up is None:
            e.weight = BESIDE_ARTICLE if has_article else 1.0
            continue
        e.weight = up.weight
        if e.tag in HOLDERS and up.article is None:
            e.weight /= BESIDE_ARTICLE
        if e.mark in (FORM, CLASS):
            base = up.article or (None if has_article else elements[0])
            e.wraps = "main" in e.holds or (e.mark == FORM and bool(e.holds)) or (base is not None and 2 * e.chars > base.chars)
        if not e.wraps:
            e.weight *= WEIGHTS[e.mark]


def _region(elements: list[_Element], lines: list[_Line]) -> _Element:
    """The content region; marks in elements below it what is cut."""
    ratio = _smooth([len(x.text) / (1 + x.tags) for x in lines])
    scores = [r * x.holder.weight for r, x in zip(ratio, lines)]
    if not any(scores):  # all is boilerplate: the ratio alone decides
        scores = ratio
        for e in elements:
            e.mark = NONE
    threshold = _threshold(scores)
    for score, line in zip(scores, lines):
        line.holder.sum += score - threshold
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.sum += e.sum
    region = max((e for e in elements if e.tag not in LEAVES), key=lambda e: e.sum)
    region = region.article or region
    whole = region.tag in PAGE
    for e in elements:
        up = e.parent
        e.inside = e is region or (up is not None and up.inside)
        if up is not None and up.inside:
            odd = (e.mark != NONE and not e.wraps) or (whole and e.tag not in LEAVES and e.tag not in PAGE)
            e.cut = up.cut or (e.sum < 0 and odd and not (e.title and e.mark <= CLASS))
    return region


def _threshold(scores: list[float]) -> float:
    return sum(scores) / len(scores) / 2


def main_text(html: str | None) -> str:
    """The main text: the region's lines in page order, joined by two line feeds."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    if not parser.lines:
        return ""
    _weigh(parser.elements, parser.lines)
    _region(parser.elements, parser.lines)
    return "\n\n".join(x.text for x in parser.lines if x.holder.inside and not x.holder.cut)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with a column ``text``, which replaces one of that name."""
    prepare(pages.sparkSession)
    kept = others(pages, html, "text")
    own = [field(c) for c in kept]
    rows = pages.select(*own, F.col(html).alias("_html"))
    schema = pages.select(*own, F.lit("").alias("text")).schema

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(x) for x in batch.column(len(kept)).to_pylist()]
        columns = [*batch.columns[: len(kept)], pa.array(found, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, "text"])

    return mapped(rows, texts, schema)
