"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags, by one scan that follows the HTML standard for tags, attributes and quotes
and takes time in proportion to the page. The first pass looks at each block alone: link density, stop-word density and
length make it good, bad, near-good or short; a block is also bad by its place (navigation, header outside an article,
footer, aside, form, class or id of an advert, notice, menu or comment section). Place is evidence too: within an article
or main element a block needs less to be good and may have more links. If such an element holds most of the good text of a
page it bounds the main text, and what stands outside is bad; teaser cards in article elements don't.

The second pass decides near-good blocks, good if a nearest decided neighbour on either side is, then the short ones, which
inherit the label of the nearest decided neighbour, good if there are two as near and one is. Blocks that are bad by place have no say about blocks within
the element that bounds the text, as an advert between two paragraphs says nothing about them; and an item of links in a list or
table there says nothing about a block without links.
"""

from __future__ import annotations

import bisect
import html as html_lib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# fixed values: element names of the HTML standard
BLOCKS = {*"address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()}
RAW = {*"script style noscript template svg math iframe object canvas video audio select textarea button title".split()}
VOID = {*"area base br col embed hr img input link meta param source track wbr".split()}
HEADINGS, LISTS = {*"h1 h2 h3 h4 h5 h6".split()}, {*"ul ol dl table".split()}
BAD_ELEMENTS = {*"nav footer aside form menu dialog fieldset".split()}
BAD_ROLES = {*"navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split()}
# names of page parts that hold no article, and parts of names that say nothing
BAD_NAMES = re.compile(
    r"ads?|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer\w*|foot|masthead|topbar|cookies?|consent|gdpr|notice\w*|alert|popup|modal|newsletter|subscri\w*|signup|login|"
    r"share|sharing|social|comment\w*|disqus|replies|respond|related\w*|recommend\w*|widget\w*|toolbar|pagination|pager|skip\w*|copyright|legal|disclaimer|paywall|tags"
)
PLAIN_NAMES = re.compile(r"\d+|[a-z]|site|page|main|global|top|bottom|left|right|primary|secondary|inner|outer|wrap\w*|container|box|block|section|area|bar|list|item\w*|links?|text|group|panel|row|col\w*|posts?|articles?|stories|content|user|reader|form|buttons?|icons?|info|unit|slot|sticky|fixed|mobile|desktop|js|is|has")
HEADER_NAMES = re.compile(r"header|head")  # bad outside an article alone
# fixed values: frequent function words
STOP = {*(
    "a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if in into is it its just like more most my new no not of on one only or other our out over she so some than that the their them then there these they this to up us was we were what when which who will with would you your "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn werden wie wir wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais même ne nous on ou par pas plus pour qu que qui sa sans se ses son sont sur tout un une vous "
    "al como con cuando de del donde el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por que se si sin sobre su sus también un una y ya"
).split()}
_WIDE = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
_OTHER = re.compile(r"[\W\d_]+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)?")
_IS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*|\d+|[^\W\d_a-zA-Z]+")
_TOLD = {"class", "id", "role", "hidden", "aria-hidden", "style"}
_RAW_END = {k: re.compile(rf"</{k}(?=[\s/>])[^>]*>", re.IGNORECASE) for k in RAW}
LINKS, LINKS_WITHIN, STOP_LOW, STOP_HIGH, SHORT, LONG = 0.33, 0.66, 0.12, 0.2, 70, 200


class Block(NamedTuple):
    """A block's text, its characters in links, whether its place is bad, whether it is inside a main (1) or article (2)
    element, whether it is a heading, and whether it is part of a list or table."""

    text: str
    linked: int
    bad: bool
    place: int
    heading: bool
    listed: bool = False


class _Tags:
    """The tags of a page, in one pass: `next` gives (start, end, name, whether it is an end tag, whether it closes itself,
    attributes that tell something), or None. Comments, declarations and the content of RAW elements have no name."""

    def __init__(self, page: str):
        self.page, self.at, self.missing = page, 0, set()

    def _find(self, what: str, at: int) -> int:
        """Where `what` comes next; what was once not found isn't sought again."""
        if what in self.missing:
            return -1
        k = self.page.find(what, at)
        if k < 0:
            self.missing.add(what)
        return k

    def next(self) -> tuple[int, int, str, bool, bool, dict[str, str]] | None:
        page, n = self.page, len(self.page)
        while (lt := page.find("<", self.at)) >= 0:
            after = page[lt + 1 : lt + 2]
            if after in ("!", "?"):
                close, skip = ("-->", 3) if page.startswith("<!--", lt) else (">", 1)
                k = self._find(close, lt + 2)
                self.at = k + skip if k >= 0 else n
                return lt, self.at, "", False, False, {}
            is_end = after == "/"
            m = _NAME.match(page, lt + 1 + is_end)
            if not m:
                self.at = lt + 1  # a sign in a text
                if is_end and (k := self._find(">", lt)) >= 0:
                    self.at = k + 1
                    return lt, self.at, "", False, False, {}
                return lt, lt + 1, "<", False, False, {}
            name, at, told = m[0].lower(), m.end(), {}
            while True:
                a = _ATTR.match(page, at)
                at = a.end()
                if a[1] is None:
                    if at < n and page[at] == "=":  # an attribute's name may start with one
                        at += 1
                        continue
                    break
                value, eq = "", _IS.match(page, at)
                if eq:
                    at = eq.end()
                    quote = page[at : at + 1]
                    k = self._find(quote, at + 1) if quote in ('"', "'") else -1
                    if k >= 0:
                        value, at = page[at + 1 : k], k + 1
                    else:
                        v = _BARE.match(page, at)
                        value, at = v[0], v.end()
                if (key := a[1].lower()) in _TOLD:
                    told.setdefault(key, value)
            self.at = min(at + 1, n)
            closed = page[at - 1 : at] == "/"
            if name in RAW and not is_end and not closed and f"</{name}" not in self.missing:
                if end := _RAW_END[name].search(page, self.at):
                    self.at = end.end()
                    return lt, self.at, "script" if name in ("script", "style") else "raw", False, True, {}
                self.missing.add(f"</{name}")
                if name in ("script", "style"):
                    self.at = n
                    return lt, n, "script", False, True, {}
            return lt, self.at, name, is_end, closed, told
        return None


def _bad_name(value: str, also: re.Pattern | None = None) -> bool:
    """Whether one of the names in a class or id is that of a part without article text: made of such names and plain ones."""
    for name in value.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        bad = [bool(BAD_NAMES.fullmatch(p) or also and also.fullmatch(p)) for p in parts]
        if any(bad) and all(b or PLAIN_NAMES.fullmatch(p) for b, p in zip(bad, parts, strict=True)):
            return True
    return False


def _bad_place(name: str, told: dict[str, str], in_article: bool) -> bool:
    if name in BAD_ELEMENTS or name == "header" and not in_article:
        return True
    if not told:
        return False
    if "hidden" in told or told.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", told.get("style", ""), re.IGNORECASE):
        return True
    if told.get("role", "").lower() in BAD_ROLES:
        return True
    return name not in ("html", "body", "article", "main") and any(_bad_name(told[k], None if in_article else HEADER_NAMES) for k in ("class", "id") if k in told)


def blocks(page: str) -> list[Block]:
    """Blocks in page order. Empty ones are left out."""
    out, text, linked = [], [], 0
    stack: list[tuple[str, bool, int, bool, bool]] = []  # name, bad, place, within a heading, within a list or table
    open_names: dict[str, int] = {}
    links, breaks, at, tags = 0, 0, 0, _Tags(page)

    def flush():
        nonlocal text, linked
        if text:
            joined = " ".join(html_lib.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, linked, *(stack[-1][1:] if stack else (False, 0, False, False))))
        text, linked = [], 0

    def put(part: str):
        nonlocal linked, breaks
        if part:
            text.append(part)
            if not part.isspace():
                breaks = 0
            if links:
                linked += len(part.strip())

    def pop_to(k: int):
        for x in stack[k:]:
            open_names[x[0]] -= 1
        del stack[k:]

    while t := tags.next():
        start, end, name, is_end, closed, told = t
        put(page[at:start])
        at = end
        if name == "<":
            put("<")
        elif name == "raw":  # its content isn't text
            text.append(" ")
        elif name in ("", "script"):
            pass
        elif is_end:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS:
                flush()
            if open_names.get(name):
                pop_to(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
        elif name == "br":
            breaks += 1
            if breaks >= 2:
                flush()
            text.append(" ")
        else:
            if name == "a":
                links += 1
            if name in BLOCKS:
                flush()
                if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack:  # their end tags may be left out
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == name or name in ("dt", "dd") and stack[k][0] in ("dt", "dd") or name in ("td", "th") and stack[k][0] in ("td", "th"):
                            pop_to(k)
                            break
                        if stack[k][0] in BLOCKS and stack[k][0] != "p" and not (name == "tr" and stack[k][0] in ("td", "th")):
                            break
                elif stack and stack[-1][0] == "p":
                    pop_to(len(stack) - 1)
            if name not in VOID and not closed and (name in BLOCKS or name in ("span", "b", "i", "em", "strong", "small", "font", "label", "a", "u")):
                bad, place, heading, listed = stack[-1][1:] if stack else (False, 0, False, False)
                place = max(place, {"article": 2, "main": 1}.get(name, 0))
                worse = bad or (name in BLOCKS or name == "span") and _bad_place(name, told, place > 0)
                if name in BLOCKS or worse != bad:
                    stack.append((name, worse, place, heading or name in HEADINGS, listed or name in LISTS))
                    open_names[name] = open_names.get(name, 0) + 1
    put(page[at:])
    flush()
    return out


def weight(text: str) -> int:
    """Characters of a text, those of scripts that need about a third as many as Latin ones counted three times."""
    return len(text) if len(text) >= LONG else len(text) + 2 * len(_WIDE.findall(text))


def first_pass(b: Block) -> str:
    """good, bad, near or short, by the block alone."""
    if b.bad or b.linked > (LINKS_WITHIN if b.place else LINKS) * len(b.text):
        return "bad"
    size = weight(b.text)
    if b.heading or size < SHORT:
        return "short"
    words = [w for w in _OTHER.split(b.text.lower()) if w]
    stop = sum(w in STOP for w in words) / max(len(words), 1)
    if stop >= (STOP_LOW if b.place else STOP_HIGH) and (b.place or size > LONG):
        return "good"
    return "short" if stop == 0 and size < LONG else "near"


def bound(found: list[Block], first: list[str]) -> int:
    """The place that bounds the main text: 2 or 1 if article or main elements hold most of the good text, or of the near-good
    if none is good, or of what isn't bad; else 0."""
    for kinds in (("good",), ("near",), ("short",)):
        size = [sum(len(b.text) for b, x in zip(found, first, strict=True) if x in kinds and b.place >= place) for place in range(3)]
        if size[0]:
            return 2 if 2 * size[2] > size[0] else 1 if 2 * size[1] > size[0] else 0
    return 0


def second_pass(found: list[Block], first: list[str], within: int) -> list[bool]:
    """Whether each block is main text: near-good blocks are decided by their neighbours, then short ones by theirs."""
    now = ["bad" if b.place < within else x for b, x in zip(found, first, strict=True)]
    mute = [x == "bad" and within > 0 and (b.bad or b.place < within) for b, x in zip(found, now, strict=True)]
    links = [x == "bad" and within > 0 and b.listed for b, x in zip(found, now, strict=True)]  # bad by their links, if not by place
    anything, near_there = "good" in now, "near" in now
    for kind in ("near", "short"):
        every, then = [k for k, x in enumerate(now) if x in ("good", "bad") and not mute[k]], now[:]
        plain = [k for k in every if not links[k]]  # those that have a say about a block without links
        for k, x in enumerate(now):
            if x != kind:
                continue
            says = every if found[k].linked else plain
            at = bisect.bisect(says, k)
            by = [(abs(d - k), now[d] == "bad") for d in says[max(at - 1, 0) : at + 1]]
            if kind == "near":  # where no block is good alone, near-good ones are the text
                good = not anything or not by or not all(bad for _, bad in by)
            else:  # nearest neighbour, the good one of two as near
                good = not min(by)[1] if by else within > 0 or not near_there
            then[k] = "good" if good else "bad"
        now = then
    return [x == "good" for x in now]


def labels(found: list[Block]) -> list[bool]:
    """Whether each block is main text, by both passes."""
    first = [first_pass(b) for b in found]
    return second_pass(found, first, bound(found, first))


def main_text(page: str | None) -> str:
    """The main text of a page, blocks joined by line breaks; empty if there is none."""
    found = blocks(page or "")
    return "\n".join(b.text for b, good in zip(found, labels(found), strict=True) if good)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page. Null html is empty, and so is the text of a page without main text; rows that
    repeat a page_id keep their own rows; pages of any length are read whole, in time in proportion to it; of two neighbours
    as near as each other the good one decides; an empty table gives an empty one; other columns are passed over."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")
