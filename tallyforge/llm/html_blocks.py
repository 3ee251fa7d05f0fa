"""Leaf blocks of a page: runs of visible text between block boundaries, with their ancestors."""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from typing import NamedTuple

NAME_END = re.compile(r"[\s/>]")
STOP = re.compile(r"""[>"']""")
DIGITS = re.compile(r"&#0*([0-9]{1,9})[0-9]*")  # more than nine digits are beyond every character
NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
# Element names of HTML.
UNSEEN = frozenset("script style template title noscript textarea select iframe object svg math head-none".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br input".split()
)
# An element of the key ends an open element of the value when it begins (looking no further than a container).
ENDS = {n: ("p",) for n in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
ENDS |= {"li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "option": ("option",)}
ENDS |= {"tr": ("p", "tr", "td", "th"), "td": ("p", "td", "th"), "th": ("p", "td", "th")}
CONTAINERS = frozenset("article aside body button details div dl fieldset footer form header html main nav ol section table td th ul".split())
CLOSE = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in UNSEEN}
DEEPEST = 200  # elements of a path; below, repeated ones are left out above the nearest two


class Tag(NamedTuple):
    start: int
    end: int
    name: str  # lower case; "!" for a comment's beginning, empty for declarations and the like
    closing: bool
    attributes: str


class Tags:
    """The tags of a page, each found from a place not before the last one's, in time linear in the page.

    A tag is `<`, perhaps `/`, a letter and all up to white space, `/` or `>`, then all up
    to the first `>` outside quotes.  Where that never comes the `<` is text, unless `!`,
    `?` or `/` follows it and a `>` comes later.  Starts that fail share what they learned:
    the ends of their names, their first stops, and the quotes after which no `>` comes.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.name_end = self.first_stop = -1  # of the latest start
        self.hopeless: set[int] = set()  # places of quotes that open and lead to no end

    def find(self, pos: int) -> Tag | None:
        page = self.page
        while 0 <= (start := page.find("<", pos)) < self.last:
            if page.startswith("<!--", start):
                return Tag(start, start + 4, "!", False, "")
            closing = page[start + 1] == "/"
            name = start + 1 + closing
            if page[name].isascii() and page[name].isalpha():
                if self.name_end < name:
                    self.name_end = NAME_END.search(page, name).start()  # `last` is one at the latest
                end = self._end(self.name_end)
                if end >= 0:
                    return Tag(start, end + 1, page[name : self.name_end].lower(), closing, page[self.name_end : end])
            if page[start + 1] in "!?/":
                return Tag(start, page.index(">", start) + 1, "", False, "")
            pos = start + 1
        return Tag(start, start + 4, "!", False, "") if start >= 0 and (start := page.find("<!--", start)) >= 0 else None

    def _end(self, pos: int) -> int:
        """Place of the first `>` from pos on that is outside quotes, or -1."""
        page, tried = self.page, []
        if self.first_stop < pos:
            self.first_stop = STOP.search(page, pos).start() if pos <= self.last else len(page)
        stop = self.first_stop
        while stop <= self.last and stop not in self.hopeless:
            if page[stop] == ">":
                return stop
            tried.append(stop)
            close = page.find(page[stop], stop + 1)
            if not 0 <= close < self.last:
                break
            stop = STOP.search(page, close + 1).start()
        self.hopeless.update(tried)
        return -1


class Block(NamedTuple):
    text: str  # references decoded, white space as one blank, trimmed, not empty
    path: tuple[str, ...]  # open elements from the outermost, as "tag name name ...", see DEEPEST
    linked: int  # characters inside links


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks in page order.  Comments, scripts, styles and other unseen elements have none.

    Unclosed paragraphs and list items end where the next begins; an end tag closes up to
    its element, one without an element is passed over; an unclosed comment or unseen
    element takes the rest of the page.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[str] = []  # tag names
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack each name is
    holders: list[int] = []  # where containers are
    paths: list[tuple[str, ...]] = [()]
    pieces: list[str] = []
    start: tuple[str, ...] = ()
    links = linked = pos = 0

    def flush() -> None:
        nonlocal pieces, linked
        text = "".join(pieces)
        if "&" in text:
            text = entities.unescape(DIGITS.sub(r"&#\1", text) if "&#" in text else text)
        text = " ".join(text.split())
        if text:
            out.append(Block(text, start, linked))
        pieces, linked = [], 0

    def pop(n: int) -> None:
        nonlocal links
        for name in stack[n:]:
            links -= name == "a"
            places[name].pop()
        while holders and holders[-1] >= n:
            holders.pop()
        del stack[n:], paths[n + 1 :]

    tags = Tags(page)
    while True:
        tag = tags.find(pos)
        piece = page[pos : tag.start if tag else len(page)]
        if piece:
            if not pieces and not piece.isspace():
                start = paths[-1]
            if pieces or not piece.isspace():
                pieces.append(piece)
            if links:
                linked += len(piece)
        if not tag:
            break
        pos, name = tag.end, tag.name
        if name == "!":
            end = page.find("-->", pos)
            pos = end + 3 if end >= 0 else len(page)
            continue
        if not name:
            continue
        if tag.closing:
            if name not in INLINE:
                flush()
            if places[name]:
                pop(places[name][-1])
            continue
        if name in UNSEEN:
            if not tag.attributes.endswith("/"):
                end = CLOSE[name].search(page, pos)
                close = page.find(">", end.end()) if end else -1
                pos = close + 1 if close >= 0 else len(page)
            continue
        if name in INLINE:
            if name == "br":
                pieces.append(" ") if pieces else None
                continue
        else:
            flush()
            ended = max((places[n][-1] for n in ENDS.get(name, ()) if places[n]), default=-1)
            if ended >= 0 and ended >= (holders[-1] if holders else 0):
                pop(ended)
        if name not in VOID:
            if name in CONTAINERS:
                holders.append(len(stack))
            places[name].append(len(stack))
            stack.append(name)
            paths.append(below(paths[-1], element(name, tag.attributes)))
            links += name == "a"
    flush()
    return out


def below(path: tuple[str, ...], name: str) -> tuple[str, ...]:
    """The path of an element inside path's."""
    if len(path) < DEEPEST or path[-2] not in path[:-2]:
        return (*path, name)
    kept = (*path[:-2], path[-1], name)
    return path if kept == path else kept


def element(name: str, attributes: str) -> str:
    """The tag and the words of its class, id and role."""
    if "=" not in attributes:
        return name
    found = " ".join(NAMES.findall(attributes)).lower()
    return " ".join([name, *sorted(set(re.findall(r"[a-z]+", found)))])
