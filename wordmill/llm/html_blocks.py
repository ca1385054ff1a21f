"""Pages as sequences of leaf blocks: the reader of operator 8.

A block is the text between two block-level tags, with the path of open
elements it stands in. Scripts, styles, drawings, comments and markup are left
out, character references decoded, white space squeezed. Text of formulas and
of objects' fallbacks is text.
"""

from __future__ import annotations

import html
import re
import zlib
from typing import NamedTuple

import numpy as np

# HTML elements by how they are read.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu
nav noscript ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul
""".split())
RAW_TAGS = frozenset("script style template svg".split())
# Tags that end a drawing which holds them, closed or not.
BREAKS_SVG = re.compile(r"</?(?:blockquote|body|center|dd|div|dl|dt|h[1-6]|head|hr|li|menu|ol|p|pre|table|ul)\b", re.I)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element of the first kind closes an open one of the second.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head", "title"}}
CLOSES |= {tag: {"p"} for tag in BLOCK_TAGS - set(CLOSES) - {"html", "head", "title", "option", "optgroup"}}
# Elements beyond which a tag closes nothing.
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
                  r"|</?([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>", re.S)
_MARKS = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple  # names of the open elements: the tag, then its class, id and role words
    text: str
    link_chars: int


def blocks(page: str) -> list[Block]:
    """The page's blocks that hold text, in page order."""
    out: list[Block] = []
    stack: list[tuple] = []  # (tag, names)
    text: list[str] = []
    links = [0, 0]  # depth of <a>, characters in links of this block

    def flush() -> None:
        whole = " ".join("".join(text).split())
        if whole:
            out.append(Block(tuple(n for _, names in stack for n in names), whole, links[1]))
        text.clear()
        links[1] = 0

    def pop_to(tags, barrier=frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in barrier:
                return

    at = 0
    while True:
        m = _TAG.search(page, at)
        chunk = page[at:m.start() if m else len(page)]
        if chunk:
            # Decoded here: a reference does not reach over a tag.
            text.append(html.unescape(chunk) if "&" in chunk else chunk)
            if links[0]:
                links[1] += len(chunk)
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[4] or "").lower()
        closing = m[1] == "/" or m[0].startswith("</")
        if tag in RAW_TAGS and not closing:
            if not m[0].endswith("/>"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                stop = BREAKS_SVG.search(page, at, end.start() if end else len(page)) if tag == "svg" else None
                at = stop.start() if stop else end.end() if end else len(page)
            text.append(" ")
        elif tag == "a":
            links[0] = 0 if closing else 1
        elif tag in BLOCK_TAGS:
            flush()
            if closing:
                pop_to({tag}, SCOPE.get(tag, frozenset()))
                links[0] = 0
            elif tag not in VOID_TAGS:
                if tag in CLOSES:
                    pop_to(CLOSES[tag], SCOPE.get(tag, frozenset()) | {"article", "section", "div", "td"} - {tag})
                marks = " ".join(x or y or z for x, y, z in _MARKS.findall(m[3] or ""))
                stack.append((tag, (tag, *(f".{w}" for w in _PART.findall(marks.lower())))))
        elif tag in VOID_TAGS:
            text.append(" ")
    flush()
    return out


PATH_DIMS, LEAF_DIMS, WORD_DIMS, NUMBERS = 64, 24, 32, 9
DIMS = PATH_DIMS + LEAF_DIMS + WORD_DIMS + NUMBERS


def _bucket(name: str, dims: int) -> int:
    return zlib.crc32(name.encode()) % dims


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block: hashed tag path, hashed last elements of it, hashed
    words, and a few numbers."""
    out = np.zeros((len(page), DIMS), np.float32)
    for row, block in zip(out, page):
        for name in block.path:
            row[_bucket(name, PATH_DIMS)] = 1
        for name in block.path[-2:]:
            row[PATH_DIMS + _bucket(name, LEAF_DIMS)] = 1
        words = block.text.lower().split()
        crc = zlib.crc32
        hits = np.bincount([crc(w.encode()) % WORD_DIMS for w in words], minlength=WORD_DIMS)
        row[PATH_DIMS + LEAF_DIMS:-NUMBERS] = 2 * hits / len(words)
        n, s = len(block.text), block.text
        row[-NUMBERS:] = (np.log1p(n) / 8, np.log1p(len(words)) / 6, min(1.0, block.link_chars / n),
                          10 * sum(map(s.count, ",;")) / n, 10 * s.count(". ") / n, s[-1] in ".!?\"",
                          s[0].isupper(), len(block.path) / 12, any(c in s for c in "©|»›•·"))
    return out
