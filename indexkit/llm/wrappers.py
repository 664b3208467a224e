"""Union-free regular expressions inferred from token streams (wrappers).

A wrapper describes the pages of one host.  It is a sequence of items; an item
is a text slot or a block (start tag, sequence, end tag), each once, optional
or repeated.  Inference aligns two streams level by level, a balanced block
being aligned as a whole:

* a text mismatch makes a slot; text equal on all pages stays a constant;
* a tag mismatch is first tried as a repetition: adjacent equal squares, of one
  block or of several, become one repeated item;
* what still has no partner becomes optional.

Aligning wrappers with wrappers is the same operation, so partial wrappers of
many tasks merge in a tree.  A wrapper holds no page text, only digests of
constants and how many characters stood in each place; its size follows the
template and not the number of pages.

Everything is plain lists, written as JSON: ``[signature, optional, repeated,
pages, chars, digest, items]``; a text slot has the signature ``#`` and a digest
or null, a repeated group of several blocks has the signature ``()``.
"""

from __future__ import annotations

import re
import zlib

from indexkit.llm.html_tokens import Block

SIG, OPTIONAL, REPEATED, PAGES, CHARS, DIGEST, ITEMS = range(7)
#: Longest square of several blocks that is tried as a repetition.
SQUARE = 6

# Fixed word lists: what is never main text, by element and by word of class, id or role.
DROPPED_NAMES = frozenset("head nav footer aside form script style template noscript iframe noembed noframes object embed "
                          "svg math canvas audio video map button select option optgroup datalist textarea input "
                          "fieldset dialog menu title".split())
DROPPED_WORDS = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar widget footer masthead banner "
                          "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion "
                          "cookie cookies consent notice notices notification alert popup modal overlay gdpr disclaimer "
                          "comment comments reply replies respond disqus discussion share sharing social related "
                          "recommended newsletter subscribe subscription signup login search toolbar pagination pager "
                          "skip copyright complementary contentinfo".split())
MAIN_NAMES = frozenset({"article", "main"})
NEVER_BY_WORD = frozenset({"", "html", "body", "main"})
#: A sequence with more items than this is described by element names only.
LONG = 200
#: A wrapper with more items than this is described so at every level.
ITEMS_MOST = 3_000
#: A child that holds this share of a block's slot text is looked into further.
MOST = 0.8
#: A constant of at least so many pages is template, where main text is inferred.
CONSTANT_PAGES = 8


def dropped(name: str, attrs: dict[str, str], words: frozenset[str], in_main: bool) -> bool:
    """Whether a block is boilerplate by what it says of itself."""
    if name in DROPPED_NAMES:
        return True
    if not attrs:
        return name == "header" and not in_main
    if name in NEVER_BY_WORD or attrs.get("role") in ("main", "article"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or \
            re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    if words & DROPPED_WORDS:
        return True
    return not in_main and (name == "header" or "header" in words)


def dropped_inline(name: str, attrs: dict[str, str]) -> bool:
    return dropped(name, attrs, Block(name, attrs).words, True)


def is_main(block: Block) -> bool:
    return block.name in MAIN_NAMES or block.attrs.get("role") in ("main", "article")


def normal(text: str) -> str:
    return " ".join(text.split())


def _holds_main(block: Block) -> bool:
    return any(isinstance(i, Block) and (i.name in MAIN_NAMES and not i.words & DROPPED_WORDS or _holds_main(i))
               for i in block.items)


def kept(block: Block, in_main: bool) -> bool:
    """A block that isn't boilerplate, or is called so but holds an article."""
    if not dropped(block.name, block.attrs, block.words if block.attrs else frozenset(), in_main):
        return True
    return block.name not in DROPPED_NAMES and not in_main and _holds_main(block)


def pattern(block: Block, in_main: bool = False) -> list:
    """The wrapper of one page, from its tree; boilerplate blocks are left out."""
    items = []
    main = in_main or is_main(block)
    for i in block.items:
        if isinstance(i, str):
            if text := normal(i):
                items.append(["#", False, False, 1, len(text), zlib.crc32(text.encode("utf-8", "replace")), []])
        elif kept(i, main):
            items.append(pattern(i, main))
    return [block.signature, False, False, 1, 0, None, fold(items)]


def merged(a: list, b: list, same_page: bool = False, repeated: bool = False) -> list:
    """Two items of one signature as one: of two pages, or of the same page,
    where neighbours are one item ``repeated``."""
    return [a[SIG], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED] or repeated,
            max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES], a[CHARS] + b[CHARS],
            a[DIGEST] if a[DIGEST] == b[DIGEST] and not same_page else None,
            align(a[ITEMS], b[ITEMS], same_page) if a[ITEMS] or b[ITEMS] else []]


def fold(items: list) -> list:
    """Adjacent squares become one repeated item."""
    out: list = []
    for i in items:
        if out and out[-1][SIG] == i[SIG] and i[SIG] != "#":
            out[-1] = merged(out[-1], i, True, True)
        else:
            out.append(i)
    for size in range(2, SQUARE + 1):
        if len(out) < 2 * size:
            break
        signs = [i[SIG] for i in out]
        k, made = 0, []
        while k < len(out):
            if signs[k:k + size] == signs[k + size:k + 2 * size] and len(signs) >= k + 2 * size:
                group = out[k:k + size]
                stop = k + size
                while signs[stop:stop + size] == signs[k:k + size]:
                    group = [merged(x, y, True) for x, y in zip(group, out[stop:stop + size])]
                    stop += size
                made.append(["()", False, True, max(x[PAGES] for x in group), 0, None, group])
                k = stop
            else:
                made.append(out[k])
                k += 1
        out = made
    return out


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence of signatures, as index pairs; equal ends
    are taken first, so equal sequences need no table."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo][SIG] == b[lo][SIG]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi][SIG] == b[-1 - hi][SIG]:
        hi += 1
    x, y = a[lo:len(a) - hi], b[lo:len(b) - hi]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i][SIG] == y[j][SIG] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    middle = []
    while i < len(x) and j < len(y):
        if x[i][SIG] == y[j][SIG]:
            middle.append((lo + i, lo + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return [*((k, k) for k in range(lo)), *middle, *((len(a) - hi + k, len(b) - hi + k) for k in range(hi))]


def _optional(item: list) -> list:
    return [item[SIG], True, *item[REPEATED:]]


def align(a: list, b: list, same_page: bool = False) -> list:
    """Two sequences as one: partners merge, the others become optional, squares fold."""
    out, i, j = [], 0, 0
    for p, q in [*_common(a, b), (len(a), len(b))]:
        out += map(_optional, a[i:p])
        out += map(_optional, b[j:q])
        if p < len(a):
            out.append(merged(a[p], b[q], same_page))
        i, j = p + 1, q + 1
    out = fold(out)
    return out if len(out) <= LONG else by_name(out)


def by_name(items: list) -> list:
    """One optional repeated item per element name, so that a sequence without
    regularity can't let a wrapper grow with the number of pages."""
    out: dict[str, list] = {}
    for i in items:
        for c in (i[ITEMS] if i[SIG] == "()" else [i]):
            name = re.split(r"[.#@]", c[SIG], maxsplit=1)[0] or "#"
            c = [name if name.isalnum() or name == "#" else "other", True, True, *c[PAGES:]]
            c[DIGEST] = None
            out[c[SIG]] = merged(out[c[SIG]], c, True, True) if c[SIG] in out else c
    return list(out.values())


def size(item: list) -> int:
    return 1 + sum(map(size, item[ITEMS]))


def _simple(item: list, depth: int) -> list:
    """Element names only, and below ``depth`` levels one slot for all text."""
    if not item[ITEMS]:
        return item
    if not depth:
        return [*item[:ITEMS], [["#", True, True, item[PAGES], volume(item), None, []]]]
    return [*item[:ITEMS], [_simple(i, depth - 1) for i in by_name(item[ITEMS])]]


def joined(a: list, b: list) -> list:
    """Wrappers of two sets of pages as one, of bounded size."""
    out = merged(a, b)
    depth = 64
    while size(out) > ITEMS_MOST:
        out, depth = _simple(out, depth), depth // 2
    return out


def volume(item: list) -> int:
    """Characters that stood in the item's slots."""
    return (item[CHARS] if item[DIGEST] is None else 0) + sum(map(volume, item[ITEMS]))


def _children(item: list) -> list:
    """Block children, those of repeated groups included."""
    return [c for i in item[ITEMS] for c in (_children(i) if i[SIG] == "()" else [i]) if c[SIG] != "#"]


def _main_signature(sig: str) -> bool:
    return re.split(r"[.#@]", sig, maxsplit=1)[0] in MAIN_NAMES or sig.endswith(("@main", "@article"))


def regions(wrapper: list) -> dict:
    """Where the pages' main text stands: ``paths`` of signatures from the root,
    and ``constants``, digests of template text by path.

    Articles count where a page marks them up, otherwise the block in which
    the slots' text is gathered; a wrapper without slots has no template to
    tell apart, so all its text counts."""
    marked: list[list[str]] = []

    def search(item: list, path: list[str]) -> None:
        for c in _children(item):
            at = [*path, c[SIG]]
            if _main_signature(c[SIG]) and not c[SIG].startswith("main"):
                marked.append(at)
            else:
                search(c, at)
    search(wrapper, [])
    if not marked:
        def mains(item: list, path: list[str]) -> None:
            for c in _children(item):
                at = [*path, c[SIG]]
                if _main_signature(c[SIG]):
                    marked.append(at)
                else:
                    mains(c, at)
        mains(wrapper, [])
    if marked:
        return {"paths": sorted(marked), "constants": {}}
    node, path = wrapper, []
    while True:
        blocks = _children(node)
        whole = volume(node)
        big = [c for c in blocks if whole and volume(c) >= MOST * whole]
        if len(big) != 1 or not _children(big[0]) or big[0][REPEATED]:
            break
        node = big[0]
        path = [*path, node[SIG]]
    constants: dict[str, list[int]] = {}

    def gather(item: list, at: list[str]) -> None:
        for c in item[ITEMS]:
            if c[SIG] == "#":
                if c[DIGEST] is not None and c[PAGES] >= CONSTANT_PAGES:
                    constants.setdefault("/".join(at), []).append(c[DIGEST])
            else:
                gather(c, at if c[SIG] == "()" else [*at, c[SIG]])
    if volume(node):
        gather(node, path)
    return {"paths": [path], "constants": constants}


def main_text(root: Block, where: dict) -> str | None:
    """Blocks of text in the regions ``where``, in page order, one line each;
    null if the page has none of the regions."""
    paths = {tuple(p) for p in where["paths"]}
    constants = where["constants"]
    lines: list[str] = []
    found = False

    def walk(block: Block, path: tuple[str, ...], inside: bool, main: bool) -> None:
        nonlocal found
        inside = inside or path in paths
        found = found or inside
        main = main or is_main(block)
        for i in block.items:
            if isinstance(i, str):
                if inside and (text := normal(i)) and not (
                        constants and zlib.crc32(text.encode("utf-8", "replace")) in constants.get("/".join(path), ())):
                    lines.append(text)
            elif kept(i, main):
                walk(i, (*path, i.signature), inside, main)
    walk(root, (), False, False)
    return "\n".join(lines) if found else None
