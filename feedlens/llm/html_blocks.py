"""HTML as a sequence of text blocks with the elements around them, in one linear pass."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

#: Comments, declarations, and tags with quoted attribute values; a tag with a quote that is never closed ends at the next >.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</?([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)(?:>|\Z)", re.S)
#: What starts a token; a tag's end is then looked up (``TagEnds``).
HEAD = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][a-zA-Z0-9:-]*+)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

RAW = frozenset(("script", "style"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr img br button input select option").split())
#: Elements that a new one of the same group ends, as their end tags may be left out.
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"},
        "dd": {"dt", "dd"}, "option": {"option"}}
SCOPES = frozenset("ul ol table tr dl select div section article main body html blockquote td".split())
MAIN = frozenset(("article", "main"))


@dataclass
class Block:
    """White-space-normal text, the features of its surroundings, its words, and the tags read since the block before."""

    text: str
    features: frozenset
    words: int
    tags: list[str] = field(default_factory=list)


def name_features(attributes: str) -> set[str]:
    out = set()
    for m in ATTRIBUTE.finditer(attributes):
        if m.group(1).lower() != "style":
            out.update("c:" + part.lower() for part in NAME_PART.findall(m.group(2) or m.group(3) or m.group(4) or ""))
    if HIDDEN.search(attributes):
        out.add("c:hidden")
    return out


class Reader:
    """Open elements, and the block being read."""

    def __init__(self):
        self.stack: list[tuple[str, frozenset]] = []
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.linked = self.total = 0
        self.tags: list[str] = []
        self.open: Counter[str] = Counter()

    def pop_from(self, k: int) -> None:
        self.open.subtract(name for name, _ in self.stack[k:])
        del self.stack[k:]

    def around(self) -> frozenset:
        return self.stack[-1][1] if self.stack else frozenset()

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append(html.unescape(raw) if "&" in raw else raw)
            size = len(raw.strip())
            self.total += size
            if "t:a" in self.around():
                self.linked += size

    def close_block(self) -> None:
        if self.pieces:
            words = "".join(self.pieces).split()
            if words:
                found = set(self.around())
                if self.linked * 2 > self.total:
                    found.add("linked")
                self.blocks.append(Block(" ".join(words), frozenset(found - {"t:a", "t:br"}), len(words), self.tags))
                self.tags = []
            self.pieces, self.linked, self.total = [], 0, 0

    def start(self, name: str, attributes: str) -> None:
        self.tags.append(name)
        if name not in INLINE:
            self.close_block()
            if name in MAIN:
                while self.stack and self.stack[-1][0] not in ("body", "html", *MAIN):
                    self.pop_from(len(self.stack) - 1)
            ends = ENDS.get(name, {"p"} if name in SCOPES or name[0] == "h" or name in ("form", "pre") else ())
            for k in range(len(self.stack) - 1, -1, -1) if any(self.open[e] for e in ends) else ():
                if self.stack[k][0] in ends:
                    self.pop_from(k)
                    break
                if self.stack[k][0] in SCOPES:
                    break
        if name == "br":
            self.pieces.append(" ")
        if name not in VOID and not attributes.endswith("/"):
            own = {"t:" + name} | (name_features(attributes) if attributes else set())
            self.stack.append((name, self.around() | own))
            self.open[name] += 1

    def end(self, name: str) -> None:
        self.tags.append("/" + name)
        if name not in INLINE:
            self.close_block()
        for k in range(len(self.stack) - 1, -1, -1) if self.open[name] else ():
            if self.stack[k][0] == name:
                self.pop_from(k)
                return
            if name in INLINE and self.stack[k][0] not in INLINE:
                return


class TagEnds:
    """Where the tags of a page end: for any place, the next ">" that stands in no quotes opened from there on.

    One pass from the end of the page, so that a page of many tags that are never closed takes linear time.
    """

    def __init__(self, page: str):
        marks = [(m.start(), m.group()) for m in re.finditer("[>\"']", page)]
        self.places = [place for place, _ in marks]
        self.ends: list[int | None] = [None] * (len(marks) + 1)  # from just before each mark, outside quotes
        after = {'"': None, "'": None}  # the end as found from just after the next quote of that kind
        for k in range(len(marks) - 1, -1, -1):
            place, char = marks[k]
            if char == ">":
                self.ends[k] = place
            else:
                self.ends[k] = after[char]
                after[char] = self.ends[k + 1]

    def after(self, place: int) -> int | None:
        return self.ends[bisect_left(self.places, place)]


def tokens_of(page: str) -> Iterator[tuple[int, int, str | None, str]]:
    """(start, end, name, attributes) of each comment (without a name) and tag in order; what lies in scripts is the caller's to skip, by
    sending the place to go on from."""
    at, ends = 0, None
    while True:
        if ends is None:
            m = TOKEN.search(page, at)
            if not m:
                return
            found = m.start(), m.end(), m.group(1) or m.group(3), m.group(2) or m.group(4) or ""
            if m.group(3):  # the page was read to its end for this tag; look up the others
                ends = TagEnds(page)
        else:
            m = HEAD.search(page, at)
            if not m:
                return
            found = m.start(), m.end(), None, ""
            if m.group(1):
                stop = ends.after(m.end())
                if stop is None:
                    stop = page.find(">", m.end())
                last = len(page) if stop < 0 else stop
                found = m.start(), min(len(page), last + 1), m.group(1), page[m.end():last]
        at = (yield found) or found[1]


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order. Scripts, styles and comments give no text."""
    reader, at, tokens = Reader(), 0, tokens_of(page)
    found = next(tokens, None)
    while found:
        start, end, name, attributes = found
        reader.text(page[at:start])
        at = end
        if name:
            name = name.lower()
            if page[start + 1] == "/":
                reader.end(name)
            else:
                if name in RAW:
                    stop = re.compile(f"</{name}", re.I).search(page, at)
                    at = stop.start() if stop else len(page)
                reader.start(name, attributes)
        try:
            found = tokens.send(at)
        except StopIteration:
            break
    reader.text(page[at:])
    reader.close_block()
    return reader.blocks
