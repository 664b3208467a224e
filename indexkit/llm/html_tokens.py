"""HTML as a stream of tokens and as a tree of blocks.

Text is decoded (character references) and belongs to the block it stands in;
inline elements only pass their text on.  Missing end tags are implied the way
browsers do for paragraphs, list items, table cells and options; an end tag
without its start tag is ignored.  Every step is linear in the page's length.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

# Fixed values of HTML: element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: A start tag on the left ends an open element on the right.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
        "option": {"option"}, "optgroup": {"option", "optgroup"}}
#: Blocks nested deeper than this are levelled into the one above them.
DEPTH = 100
#: Start tags that do not end an open paragraph.
_IN_P = INLINE | VOID - {"hr"} | RAW | {"button", "svg", "select", "option", "object", "video", "audio", "canvas", "noscript"}

_TOKEN = re.compile(r"<(?:!--(?P<comment>)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>"
                    r"|(?P<odd>[!?/]))")
_START = re.compile(r"<[a-zA-Z!?/]")
_ATTR = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NUMBER = re.compile(r"\d+")


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kind is ``start``, ``end`` or ``text``.
    Comments, declarations and the content of raw elements are left out; an
    unclosed one reaches to the end of the page."""
    at, n = 0, len(page)
    while at < n:
        c = _START.search(page, at)
        if text := page[at:c.start() if c else n]:
            yield "text", _html.unescape(text), ""
        # one try a place: a tag that never ends takes the rest of the page
        m = _TOKEN.match(page, c.start()) if c else None
        if m is None:
            return
        at = m.end()
        if m["comment"] is not None:
            stop = re.compile(r"--!?>").search(page, at - 2)
            at = stop.end() if stop else n
        elif m["odd"]:
            stop = page.find(">", at)
            at = stop + 1 if stop >= 0 else n
        else:
            name = m["name"].lower()
            yield ("end" if m["end"] else "start"), name, m["attrs"]
            if name in RAW and not m["end"]:
                stop = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = stop.start() if stop else n


class Block:
    """A block element: ``items`` are decoded text runs and blocks in order."""

    __slots__ = ("name", "attrs", "items")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs = name, attrs
        self.items: list[Block | str] = []

    @property
    def words(self) -> frozenset[str]:
        """Words of class, id and role, lower case, numbers left out."""
        text = " ".join(self.attrs.get(a, "") for a in ("class", "id", "role"))
        text = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", text)
        return frozenset(re.findall(r"[a-z]+", text.lower()))

    @property
    def signature(self) -> str:
        """What makes two blocks the same in a wrapper: name, first class (of a
        division without one, its id) and role, numbers levelled."""
        a = self.attrs
        if not a:
            return self.name
        out, classes = self.name, a.get("class", "").split()
        if classes:
            out += f".{classes[0]}"
        elif self.name in ("div", "section", "main") and a.get("id"):
            out += f"#{a['id']}"
        return _NUMBER.sub("0", out) + (f"@{a['role']}" if a.get("role") else "")


def tree(page: str, dropped_inline) -> Block:
    """The page's blocks under one root.  ``dropped_inline(name, attributes)``
    tells the inline elements that are kept apart as blocks, so that they can
    be dropped."""
    root = Block("", {})
    stack = [root]
    inline: list[str] = []  # open inline elements that became blocks

    def text(value: str) -> None:
        items = stack[-1].items
        if items and isinstance(items[-1], str):
            items[-1] += value
        else:
            items.append(value)

    for kind, name, rest in tokens(page):
        if kind == "text":
            text(name)
            continue
        if kind == "start":
            if name in INLINE:
                if name == "br":
                    text(" ")
                if name in VOID or not rest or "=" not in rest and "hidden" not in rest:
                    continue
                attrs = attributes(rest)
                if not dropped_inline(name, attrs):
                    continue
                inline.append(name)
            else:
                attrs = attributes(rest) if rest else {}
                while inline and name not in _IN_P and stack[-1].name in INLINE:
                    inline.remove(stack.pop().name)
                if name not in _IN_P and stack[-1].name == "p":
                    stack.pop()
                for _ in range(3):
                    if stack[-1].name in ENDS.get(name, ()):
                        stack.pop()
            block = Block(name, attrs)
            stack[-1].items.append(block)
            if name not in VOID and len(stack) < DEPTH:
                stack.append(block)
        elif name not in INLINE or name in inline:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    inline = [b.name for b in stack[:k] if b.name in INLINE]
                    del stack[k:]
                    break
    return root
