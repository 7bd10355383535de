"""Leaf blocks of web pages: the text between two boundaries of block elements, and what is around it.

One pass over the markup, linear in the page: elements are opened and closed as
browsers do it (paragraphs, list items, rows and cells end by themselves; end
tags without a start are passed over), raw text elements and comments are
skipped.  A comment, raw text or quoted attribute that never ends takes the
rest of the page, or, for an attribute, counts as unquoted.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple
from zlib import crc32

import numpy as np

#: Hash sizes of path and word features, and how many elements of a path count, from the block up.
PATHS, WORDS, DEPTH = 4096, 1024, 24

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style title textarea iframe noembed noframes xmp template svg math object audio video canvas".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup html label legend li main menu nav noscript ol optgroup option p pre search section select summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: Elements that an open paragraph goes on through.
IN_PARAGRAPH = frozenset("button label select option optgroup noscript".split())
#: What a start tag ends, and what it looks for no further than.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "caption"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
ENDS |= {"dd": ENDS["dt"], "th": ENDS["td"], "thead": ENDS["tbody"], "tfoot": ENDS["tbody"]}

MARK = re.compile(r"<(?=[a-zA-Z/!?])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
QUOTED = re.compile(r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)|\b(hidden|aria-hidden)\b""", re.IGNORECASE)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
RAW_END = {name: re.compile(rf"</{name}(?![^\s/>])", re.IGNORECASE) for name in RAW}
COMMENT_END = re.compile(r"--!?>")
WORD = re.compile(r"\w+")


class Block(NamedTuple):
    """A block's text, the elements around it from the outermost on, and how many of its characters are links."""

    text: str
    path: tuple[str, ...]
    linked: int


def described(name: str, attributes: str) -> str:
    """An element as its name and the words of its class, id and role: ``div post content``."""
    if not attributes or attributes.isspace():
        return name
    words = [name]
    for key, value, hidden in ATTRIBUTE.findall(attributes):
        words += [hidden.lower()] if hidden else [t.lower() for t in TOKEN.findall(value)]
    return " ".join(dict.fromkeys(words))


class _Reader:
    """The state of one pass over a page."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.names: list[str] = []
        self.path: list[str] = []
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = 0
        self.link_depth: int | None = None

    def say(self, text: str) -> None:
        text = html.unescape(text)
        self.parts.append(text)
        if self.link_depth is not None:
            self.linked += len(text.strip())

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, tuple(self.path[-DEPTH:]), min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def pop_to(self, size: int) -> None:
        for name in self.names[size:]:
            self.open[name] -= 1
        del self.names[size:], self.path[size:]
        if self.link_depth is not None and self.link_depth > size:
            self.link_depth = None

    def start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.link_depth = len(self.names)
        elif name in ("br", "img", "wbr", "input"):
            self.parts.append("" if name == "wbr" else " ")
        elif name == "hr":
            self.flush()
        if name not in BLOCK:
            return
        self.flush()
        if self.names and self.names[-1] == "p" and name not in IN_PARAGRAPH:
            self.pop_to(len(self.names) - 1)
        ended, last = ENDS.get(name, (frozenset(), frozenset()))
        if any(self.open[e] for e in ended):
            found = None
            for i in range(len(self.names) - 1, -1, -1):
                if self.names[i] in last:
                    break
                if self.names[i] in ended:
                    found = i
            if found is not None:
                self.pop_to(found)
        self.names.append(name)
        self.path.append(described(name, attributes))
        self.open[name] += 1

    def end(self, name: str) -> None:
        if name == "a":
            self.link_depth = None
        elif name in BLOCK:
            self.flush()
            if self.open[name]:
                at = len(self.names) - 1
                while self.names[at] != name:
                    at -= 1
                self.pop_to(at)


def read_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order; a null page has none."""
    page = page or ""
    reader = _Reader()
    at = 0
    while mark := MARK.search(page, at):
        here = mark.start()
        if here > at:
            reader.say(page[at:here])
        kind = page[here + 1]
        if kind in "!?" or (kind == "/" and not NAME.match(page, here + 2)):
            if page.startswith("<!--", here):
                close = COMMENT_END.search(page, here + 2 if page.startswith(("<!-->", "<!--->"), here) else here + 4)
                at = close.end() if close else len(page)
            elif kind == "/" and here + 2 >= len(page):
                reader.say("</")
                at = len(page)
            else:
                close = page.find(">", here + 2)
                at = close + 1 if close >= 0 else len(page)
            continue
        name = NAME.match(page, here + 2 if kind == "/" else here + 1)
        tag = QUOTED.match(page, name.end())
        at = tag.end() if tag else len(page)
        element = name.group().lower()
        if kind == "/":
            reader.end(element)
            continue
        attributes = page[name.end() : at - 1]
        if element not in RAW:
            reader.start(element, attributes)
        elif element not in ("svg", "math") or not attributes.endswith("/"):
            close = RAW_END[element].search(page, at)
            end = page.find(">", close.end()) if close else -1
            at = end + 1 if end >= 0 else len(page)
    if at < len(page):
        reader.say(page[at:])
    reader.flush()
    return reader.blocks


def _hashed(word: str, size: int) -> int:
    return crc32(word.encode()) % size


_path_ids: dict[str, list[int]] = {}


def path_ids(path: tuple[str, ...]) -> list[int]:
    """Hashed features of the elements around a block; its own element counts apart as well."""
    if len(_path_ids) > 1 << 16:
        _path_ids.clear()
    out: set[int] = set()
    for element in path:
        known = _path_ids.get(element)
        if known is None:
            name, *words = element.split()
            known = _path_ids[element] = [_hashed(x, PATHS) for x in [name, *words, *(f"{name}.{w}" for w in words)]]
        out.update(known)
    if path:
        name, *words = path[-1].split()
        out.update(_hashed(f"own:{x}", PATHS) for x in [name, *words])
        if len(path) > 1:
            out.add(_hashed(f"above:{path[-2].split()[0]}", PATHS))
    return sorted(out)


def word_ids(text: str) -> list[int]:
    """Hashed words of a block, each once."""
    return sorted({_hashed(w, WORDS) for w in set(WORD.findall(text.lower()))})


def shape(block: Block, place: int, blocks: int) -> list[float]:
    """Length, links, marks and place of a block as numbers around 0 to 1."""
    text = block.text
    size = len(text)
    return [
        min(np.log1p(size) / 8, 2.0),
        block.linked / size,
        sum(map(text.count, ".,;:!?")) / size * 10,
        float(text[-1] in ".!?:;\"'"),
        place / blocks,
        (blocks - 1 - place) / blocks,
    ]
