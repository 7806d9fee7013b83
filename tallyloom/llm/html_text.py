"""Main text of web pages by two passes of block rules.

A page is cut into blocks of text between block-level tags. The first pass decides a block by link density, length
and stop-word density, on every page; blocks inside a menu, advert, form or comment list are bad, and so are short
copyright notices outside the article. What these signs leave open stays ambiguous: short blocks, and in the article
also long ones with many links or few stop words. The second pass gives an ambiguous block the label of the nearest
decided block, above or below, with no border of the article between them; blocks inside menus and the like are no
neighbours. The article's mark decides only where none is. Good blocks are joined in page order, so long prose outside
an article element counts too. Work is in proportion to the page, whatever its markup.

The stop words are those of English, French, German and Spanish. On a page in another language they do not count.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.tables import slices

SLICE = 16_000_000
MANY_LINKS, STOPS_HIGH, STOPS_LOW, LONG, SHORT = 0.5, 0.25, 0.1, 30, 8
#: Element names of HTML, and frequent function words of four languages.
HIDDEN = "script style noscript template svg math iframe object canvas title textarea select button"
BOILER = {"nav", "footer", "aside", "form", "header", "menu", "dialog"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "img", "wbr", "br",
}
STOP_WORDS = frozenset(
    "the of and to in is it that for on with as at by this from be are was or an not his her they which you we "
    "le la les de des du et un une est que qui dans pour par sur pas au aux avec en il elle ce se "
    "der die das und den dem von zu mit ist nicht ein eine auf für als auch es sich im sie er wir "
    "el los las y del por con para su al lo como una más pero sus le ya o este sí porque".split()
)
_BAD_NAMES = (
    "ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|banner|sidebar|menu|nav|navbar|navigation|"
    "footer|header|masthead|breadcrumb|breadcrumbs|comment|comments|disqus|replies|cookie|cookies|consent|notice|alert|"
    "share|sharing|social|related|recommended|widget|popup|modal|newsletter|subscribe|signup|login|search|pagination|pager|toolbar|copyright"
)
_BAD = re.compile(rf"(?:^|[\s_-])(?:{_BAD_NAMES})(?=$|[\s_-])", re.I)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<hidden>{'|'.join(HIDDEN.split())})\b[^>]*(?:>.*?(?:</(?P=hidden)\s*>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.I | re.S,
)
_QUOTE_OR_END = re.compile("[>\"']")
_NOTICE = re.compile(r"©|\(c\)|copyright\b", re.I)
_WORD = re.compile(r"[^\W\d_]+")
#: Letters of Thai, Lao, Burmese and Khmer, kana, and Chinese characters.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")


@dataclass
class Block:
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    main: bool = False
    boiler: bool = False
    text: str = ""


class _Tags:
    """Where the tags of a page end, worked out for every ``>`` and quote of the page once, from the last to the first."""

    def __init__(self, html: str):
        marks = list(_QUOTE_OR_END.finditer(html))
        self.places = [m.start() for m in marks]
        n = len(marks)
        self.quoted, self.plain = [-1] * (n + 1), [len(html)] * (n + 1)
        later: dict[str, int] = {}
        for i in range(n - 1, -1, -1):
            sign = marks[i][0]
            if sign == ">":
                self.quoted[i] = self.plain[i] = self.places[i] + 1
            else:
                self.plain[i] = self.plain[i + 1]
                if sign in later:
                    self.quoted[i] = self.quoted[later[sign] + 1]
                later[sign] = i

    def end(self, at: int) -> int:
        """The place after the tag whose attributes begin at ``at``. A ``>`` within quotes does not end it, unless no
        other one does."""
        i = bisect_left(self.places, at)
        return self.quoted[i] if self.quoted[i] >= 0 else self.plain[i]


def _tokens(html: str) -> Iterator[tuple[re.Match, str]]:
    """Matches of ``_TOKEN`` one after the other, with the attributes and end of a tag."""
    tags, at = _Tags(html), 0
    while at < len(html):
        token = _TOKEN.match(html, at)
        end = tags.end(token.end()) if token["tag"] else token.end()
        yield token, html[token.end() : end]
        at = end


def blocks(html: str) -> list[Block]:
    """The blocks with text, in page order. A tag or comment cut off by the end of the page is left out."""
    found, current = [], Block()
    open_tags: list[tuple[str, bool, bool]] = []  # name, inside the article, inside boilerplate
    open_names: Counter[str] = Counter()
    links = 0

    def close():
        nonlocal current
        current.text = " ".join("".join(current.pieces).split())
        if current.text:
            found.append(current)
        main, boiler = open_tags[-1][1:] if open_tags else (False, False)
        current = Block(main=main, boiler=boiler)

    for token, rest in _tokens(html):
        text = token["text"]
        if text is not None:
            piece = unescape(text)
            current.pieces.append(piece)
            if links:
                current.linked += len(piece.strip())
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if token["end"] else 1
        if tag in INLINE:
            if tag == "br":
                current.pieces.append(" ")
            if not _MARKED.search(rest):
                continue
        if token["end"]:
            if open_names[tag]:
                closed = None
                while closed != tag:
                    closed = open_tags.pop()[0]
                    open_names[closed] -= 1
                links = 0 if tag not in INLINE else links
                close()
            elif tag not in INLINE:
                close()
            continue
        if tag in VOID:
            if tag not in INLINE:
                close()
            continue
        main, boiler = open_tags[-1][1:] if open_tags else (False, False)
        names = " ".join(_MARKED.findall(rest)).replace('"', " ").replace("'", " ")
        if tag in MAIN or re.search(r"(?:^|\s)main(?:$|\s)", names):
            main, boiler = True, bool(_BAD.search(names)) or main and boiler
        elif tag in BOILER and not (tag == "header" and main) or names and _BAD.search(names):
            boiler = True
        elif tag == "p" and open_tags and open_tags[-1][0] == "p":
            open_tags.pop()
            open_names["p"] -= 1
            main, boiler = open_tags[-1][1:] if open_tags else (False, False)
        if tag in INLINE:
            if not boiler or open_tags and open_tags[-1][2]:
                continue  # an inline element matters only where it opens boilerplate
        open_tags.append((tag, main, boiler))
        open_names[tag] += 1
        close()
    close()
    return found


def _nearest(first: list[bool | None], places: list[int]) -> dict[int, list[tuple[int, bool]]]:
    """For each undecided one of ``places``: (distance, label) of the nearest decided ones above and below it."""
    decided = [i for i in places if first[i] is not None]
    found, after = {}, 0
    for i in places:
        while after < len(decided) and decided[after] < i:
            after += 1
        if first[i] is None:
            found[i] = [(abs(decided[j] - i), first[decided[j]]) for j in (after - 1, after) if 0 <= j < len(decided)]
    return found


def _words(text: str) -> tuple[int, float]:
    """The number of words, in scripts without spaces two letters each, and the share of them on the list."""
    found = _WORD.findall(text.lower())
    n = len(found) if text.isascii() else len(found) + len(_UNSPACED.findall(text)) // 2
    return n, sum(w in STOP_WORDS for w in found) / max(n, 1)


def first_pass(page: list[Block]) -> list[bool | None]:
    """What length, links and stop words say of each block, and boilerplate tags; None if that is too little.

    The list fits a page if blocks with its words hold at least as many words as those almost without. Where it does
    not fit, because the page is in another language, length alone makes a block with few links text.
    """
    counted = [(0, 0.0) if b.boiler else _words(b.text) for b in page]
    linked = [b.linked > MANY_LINKS * len(b.text) for b in page]
    known = strange = 0
    for (n, stops), links in zip(counted, linked, strict=True):
        if n >= SHORT and not links:
            known, strange = (known + n, strange) if stops >= STOPS_LOW else (known, strange + n)
    fits = known >= strange or strange < LONG
    first: list[bool | None] = []
    for b, (n, stops), links in zip(page, counted, linked, strict=True):
        if b.boiler:
            first.append(False)
        elif not b.main and n < LONG and _NOTICE.match(b.text):
            first.append(False)
        elif links:
            first.append(None if b.main and n >= SHORT else False)
        elif n >= SHORT and (stops >= STOPS_HIGH or not fits and stops < STOPS_LOW) or n >= LONG and stops >= STOPS_LOW:
            first.append(True)
        elif n >= LONG and not b.main:
            first.append(False)
        else:
            first.append(None)
    return first


def labels(page: list[Block]) -> list[bool]:
    """Which blocks are main text."""
    first = first_pass(page)
    marked = any(b.main and not b.boiler for b in page)
    result = [bool(label) for label in first]
    for inside, part in groupby(range(len(page)), key=lambda i: page[i].main):
        # A menu or an advert is no neighbour: its element parts it from the blocks beside it.
        places = [i for i in part if not page[i].boiler]
        for i, near in _nearest(first, places).items():
            # The nearer one wins, a good one among equals. Without any, the article's mark decides if the page has one.
            result[i] = min(near, key=lambda x: (x[0], not x[1]))[1] if near else inside or not marked
    return result


def main_text(html: str | None) -> str:
    page = blocks(html or "")
    return "\n\n".join(b.text for b, good in zip(page, labels(page), strict=True) if good)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (its code points) per page. A null, empty or text-free page
    has the text ''. Repeated rows give repeated rows; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", SLICE):
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
