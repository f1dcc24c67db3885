"""Main text of web pages by tag-path ratios.

A page becomes blocks: runs of text between borders of block elements, in page order, each
with the path of block elements from the root to it. Blocks of one path are alike: the path's
text ratio is its text outside links per block, its punctuation ratio the marks per block. Both
are smoothed along the page, fused, and paths above a threshold are content. Headings, items
and the like inside the elements that hold content belong to it; elements that are there for
something else (menus, adverts, comments) are left out before anything is counted.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardlake.llm.naming import unused
from cardlake.llm.shipping import ship_package

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose start ends an open element of the second kind, unless one of the third lies between.
ENDS = (
    ("li", ("li",), ("ul", "ol", "menu", "dir")),
    ("dt dd", ("dt", "dd"), ("dl",)),
    ("tr", ("tr", "td", "th"), ("table",)),
    ("td th", ("td", "th"), ("tr", "table")),
    ("thead tbody tfoot", ("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    ("option optgroup", ("option",), ("select",)),
)
KEEPS_PARAGRAPH = frozenset("option optgroup legend caption head body html tbody thead tfoot tr td th".split())
PARAGRAPH_BORDERS = frozenset("td th caption table button object".split())

# Elements that never hold the article, and words in class, id and role that tell the same.
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog footer head header iframe menu nav noembed noframes noscript object script "
    "select style svg template textarea title xmp audio video map".split())
CUES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment commentlist comments "
    "consent contentinfo complementary cookie cookies copyright dialog disclaimer disqus footer gdpr header login "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion "
    "recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar".split())
NO_CUE_AFTER = frozenset("has no with without".split())
ARTICLE_CUES = frozenset("article articlebody main".split())
TEXT_LIKE = HEADINGS | frozenset("p li blockquote pre dt dd figcaption caption td th summary legend address".split())

# Weights of a block's neighbours in page order, its own in the middle.
SMOOTHING = np.array([1.0, 4.0, 6.0, 4.0, 1.0]) / 16.0
THRESHOLD_DEVIATIONS = 0.8
ARTICLE_FACTOR = 8.0
# A form with so much of the text is the whole page, not an input form.
WHOLE_PAGE = 0.9

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^<>\"']*)>")
_OPENING = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)?))?+""")
_SPACES = re.compile(r"[\s/]*+")
_CUE_ATTRIBUTE = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_MARKS = re.compile(r"[.,;:!?¡¿…。，、；：！？؟،।]")


def attributes(source: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from a place after the tag's name, and the place after the tag (-1: never ends)."""
    found: dict[str, str] = {}
    while True:
        at = _SPACES.match(source, at).end()
        if at >= len(source):
            return found, -1
        if source[at] == ">":
            return found, at + 1
        match = _ATTRIBUTE.match(source, at)
        if match is None:  # a lone sign of equality
            at += 1
            continue
        value = next((v for v in match.groups()[1:] if v is not None), "")
        found.setdefault(match.group(1).lower(), html.unescape(value) if "&" in value else value)
        at = match.end()
        if at < len(source) and source[at] in "\"'" and source[at - 1] == "=":  # a quote that never ends
            return found, -1


@dataclass
class Element:
    """An open or closed element; ``path`` numbers the chain of block elements down to it."""

    tag: str
    parent: int
    path: int
    out: bool = False  # left out for certain, by itself or by an element around it
    doubt: int = -1  # the outermost element around it that is left out unless it holds the article
    article: int = -1  # the innermost article around it


@dataclass
class Page:
    """The elements and text blocks of one page."""

    elements: list[Element] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    owners: list[int] = field(default_factory=list)  # the element of each block
    linked: list[int] = field(default_factory=list)  # characters of each block within links


def _cues(tag: str, found: dict[str, str]) -> tuple[bool, bool, bool]:
    """Whether attributes call the element something else, an article, and whether they hide it."""
    words = [w.lower() for name in ("class", "id", "role") for w in [*_WORD.findall(found.get(name, "")), "no_word"]]
    other = any(w in CUES and before not in NO_CUE_AFTER for before, w in zip(["", *words], words))
    article = tag in ("article", "main") or found.get("role", "").lower() in ("article", "main") or any(
        w.lower() in ARTICLE_CUES for w in found.get("itemprop", "").split())
    hidden = "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))
    return other, article, hidden


class _Reader:
    """Builds a page from its source in one pass; every step only moves forward."""

    def __init__(self, source: str) -> None:
        self.source, self.page = source, Page()
        self.paths: dict[tuple[int, str], int] = {}
        self.stack: list[int] = []
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.links, self.link_at = 0, -1
        self._push("", {}, True)

    def _push(self, tag: str, found: dict[str, str], block: bool) -> None:
        elements = self.page.elements
        number = len(elements)
        if not elements:
            elements.append(Element(tag, -1, 0))
        else:
            parent = self.stack[-1]
            around = elements[parent]
            other, article, hidden = _cues(tag, found) if found else (False, tag in ("article", "main"), False)
            label = f"{tag}.{' '.join(found.get('class', '').split()[:1])}"
            path = self.paths.setdefault((around.path, label), len(self.paths) + 1) if block else around.path
            new = Element(tag, parent, path, around.out or hidden or tag in LEFT_OUT, around.doubt, around.article)
            if new.doubt < 0 and (tag == "form" or other and tag not in ("html", "body", "main")):
                new.doubt = number
            if article:
                new.article = number
            elements.append(new)
        self.stack.append(number)
        self.open[tag] += 1

    def _pop(self) -> None:
        gone = self.page.elements[self.stack.pop()].tag
        self.open[gone] -= 1
        if len(self.stack) <= self.link_at:
            self.link_at = -1

    def _flush(self) -> None:
        """Ends the block: what was read since the last border."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.page.texts.append(text)
                self.page.owners.append(self.stack[-1])
                self.page.linked.append(min(self.links, len(text)))
            self.parts, self.links = [], 0

    def _text(self, text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            self.parts.append(text)
            if self.link_at >= 0:
                self.links += len(" ".join(text.split()))

    def _close_up_to(self, tags: tuple[str, ...], borders: frozenset | tuple) -> None:
        """Closes the innermost open element of ``tags`` and all inside it, if no border lies between."""
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.page.elements[self.stack[at]].tag
            if tag in tags:
                while len(self.stack) > at:
                    self._pop()
                return
            if tag in borders or (tag in BLOCK and tags == ("p",)):
                return

    def _start(self, tag: str, found: dict[str, str]) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag == "hr":
            self._flush()
            self._close_up_to(("p",), PARAGRAPH_BORDERS)
        elif tag in BLOCK:
            if tag in ("html", "body") and self.open[tag]:
                return
            self._flush()
            if tag not in KEEPS_PARAGRAPH:
                self._close_up_to(("p",), PARAGRAPH_BORDERS)
            if tag in HEADINGS:
                top = self.page.elements[self.stack[-1]].tag
                if top in HEADINGS:
                    self._pop()
            if tag == "body":
                self._close_up_to(("head",), ())
            for tags, ended, borders in ENDS:
                if tag in tags.split():
                    while (before := len(self.stack)) and self._close_up_to(ended, borders) is None and len(self.stack) < before:
                        pass
            self._push(tag, found, True)
        elif tag == "a":
            self.link_at = len(self.stack) - 1 if "href" in found else -1
        elif tag not in VOID and (tag in LEFT_OUT or (found and any(_cues(tag, found)))):
            self._flush()  # so that a block lies inside the element or outside it as a whole
            self._push(tag, found, False)

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.link_at = -1
        elif tag == "p" and not self.open["p"] or tag == "br":
            self.parts.append(" ")
        elif self.open[tag]:
            block = tag in BLOCK
            at = len(self.stack) - 1
            while self.page.elements[self.stack[at]].tag != tag:
                if not block and self.page.elements[self.stack[at]].tag in BLOCK:
                    return  # closed with the block around it
                at -= 1
            self._flush()
            if at > 0:
                while len(self.stack) > at:
                    self._pop()

    def read(self) -> Page:
        source, at, size = self.source, 0, len(self.source)
        while at < size:
            sign = source.find("<", at)
            if sign < 0:
                self._text(source[at:])
                break
            self._text(source[at:sign])
            match = _TAG.match(source, sign)
            if match:
                closing, tag, rest = match.groups()
                at = match.end()
                found = {}
                if rest and not closing and (_CUE_ATTRIBUTE.search(rest) or "href" in rest.lower()):
                    found, _ = attributes(source, match.end(2))
            else:
                match = _OPENING.match(source, sign)
                if match is None:
                    if source.startswith("<!--", sign):
                        if source.startswith((">", "->"), sign + 4):
                            at = source.find(">", sign) + 1
                        else:
                            end = source.find("-->", sign + 4)
                            at = end + 3 if end >= 0 else size
                    elif source.startswith(("<!", "<?", "</"), sign):
                        end = source.find(">", sign)
                        at = end + 1 if end >= 0 else size
                    else:
                        self._text("<")
                        at = sign + 1
                    continue
                closing, tag = match.groups()
                found, at = attributes(source, match.end())
                if at < 0:  # the page breaks off within a tag
                    break
            tag = tag.lower()
            if closing:
                self._end(tag)
            else:
                if tag in RAW:  # no markup inside, and never a part of the article
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    if end is None:
                        break
                    close = source.find(">", end.end())
                    if close < 0:
                        break
                    at = close + 1
                else:
                    self._start(tag, found)
        self._flush()
        return self.page


def _smoothed(values: np.ndarray) -> np.ndarray:
    """Weighted means of each value and its neighbours; the ends have fewer."""
    half = len(SMOOTHING) // 2
    around = np.convolve(values, SMOOTHING)[half:half + len(values)]
    return around / np.convolve(np.ones(len(values)), SMOOTHING)[half:half + len(values)]


def _candidates(page: Page) -> list[int]:
    """Blocks that no element leaves out."""
    elements = page.elements
    held = [i for i, owner in enumerate(page.owners) if not elements[owner].out]
    if all(elements[page.owners[i]].doubt < 0 for i in held):
        return held
    plain = {i: len(page.texts[i]) - page.linked[i] for i in held}
    total, within, articles = max(1, sum(plain.values())), Counter(), set()
    for e in elements:  # an element in doubt that has an article inside is the page around it
        if e.article >= 0 and e.doubt >= 0 and not e.out and elements[e.article].doubt == e.doubt and e.doubt < e.article:
            articles.add(e.doubt)
    for i in held:
        within[elements[page.owners[i]].doubt] += plain[i]
    free = {d for d in within if d < 0 or d in articles or (elements[d].tag == "form" and within[d] >= WHOLE_PAGE * total)}
    return [i for i in held if elements[page.owners[i]].doubt in free]


def _without_menus(page: Page, blocks: list[int]) -> list[int]:
    """Drops items that are nothing but links from lists that hold little else."""
    lists: dict[int, list[int]] = defaultdict(list)
    for i in blocks:
        element = page.elements[page.owners[i]]
        if element.tag == "li":
            lists[element.parent].append(i)
    dropped = set()
    for items in lists.values():
        links = [i for i in items if page.linked[i] >= len(page.texts[i])]
        if len(items) > 1 and len(links) >= 0.8 * len(items):
            dropped.update(links)
    return [i for i in blocks if i not in dropped]


def content_blocks(page: Page) -> list[int]:
    """Numbers of the blocks of the main text, in page order."""
    elements = page.elements
    blocks = _without_menus(page, _candidates(page))
    if not blocks:
        return []
    inside = [i for i in blocks if elements[page.owners[i]].article >= 0]
    paths = np.array([elements[page.owners[i]].path for i in blocks])
    names, own = np.unique(paths, return_inverse=True)
    per_path = np.bincount(own)
    text = np.array([max(0, len(page.texts[i]) - page.linked[i]) for i in blocks], dtype=float)
    marks = np.array([len(_MARKS.findall(page.texts[i])) for i in blocks], dtype=float)
    text_ratio = (np.bincount(own, text) / per_path)[own]
    mark_ratio = (np.bincount(own, marks) / per_path)[own]
    fused = _smoothed(text_ratio) * (1.0 + _smoothed(mark_ratio))
    # The smoothed course is cut back where a block's own path holds no text.
    fused = np.minimum(fused, text_ratio * (1.0 + mark_ratio) * 4.0)
    if inside:
        fused *= np.where(np.isin(blocks, inside), ARTICLE_FACTOR, 1.0)
    score = np.bincount(own, fused) / per_path
    chosen = (score >= THRESHOLD_DEVIATIONS * fused.std())[own] & (fused > 0)
    if inside and not chosen[np.isin(blocks, inside)].any():
        inside = []
    if inside:
        chosen &= np.isin(blocks, inside)

    def parent(owner: int) -> int:
        up = elements[owner].parent
        return up if up >= 0 else owner

    holders = {parent(page.owners[i]) for i, c in zip(blocks, chosen) if c}
    areas = {elements[page.owners[i]].article for i, c in zip(blocks, chosen) if c} - {-1} if inside else set()
    covered = np.zeros(len(elements), dtype=bool)  # inside a holder that is not the whole page
    for number, e in enumerate(elements):
        whole = e.tag in ("", "html", "body")
        covered[number] = (number in holders and not whole) or (e.parent >= 0 and covered[e.parent])
    result = []
    for i, c in zip(blocks, chosen):
        owner = page.owners[i]
        if c:
            result.append(i)
        elif inside:
            if elements[owner].article in areas:
                result.append(i)
        elif elements[owner].tag in TEXT_LIKE:
            if parent(owner) in holders or covered[owner]:
                result.append(i)
    return result


def main_text(source: str) -> tuple[str, int]:
    """The main text of a page and the number of its blocks."""
    page = _Reader(source).read()
    found = content_blocks(page)
    return " ".join(page.texts[i] for i in found), len(found)


def extract(
    pages: DataFrame, html_column: str = "html", text_column: str = "text", blocks_column: str = "text_blocks"
) -> DataFrame:
    """``pages`` with the main text of every page and the number of blocks it was joined from.

    Blocks are joined in page order by one space, with white space inside them made one space
    and character references decoded. Null and empty sources, and pages where nothing is
    content, give an empty text with 0 blocks. Markup may be broken: elements left open end
    as browsers end them, a page that breaks off within a tag ends before it. Input columns
    called like a new one are replaced, all others pass through. One narrow pass over whole
    pages; memory grows with the size of a page.
    """
    ship_package(pages.sparkSession)

    @F.pandas_udf("struct<text: string, blocks: int>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([main_text(s) for s in batch], columns=["text", "blocks"])

    name = unused(pages.columns, "main_text")
    source = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    return pages.withColumn(name, read(source)).withColumns({
        text_column: F.col(name)["text"], blocks_column: F.col(name)["blocks"]}).drop(name)
