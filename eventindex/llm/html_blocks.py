"""Leaf blocks of HTML pages: a tolerant scan of tags, no tree is built.

A block is a stretch of text between the borders of block elements. Its ancestors are the open block
elements; what is never closed ends with its nearest closed ancestor. Text of scripts, styles, the
head and other raw elements belongs to no block, nor does text of elements hidden by `hidden`,
`aria-hidden="true"`, `display: none` or `visibility: hidden`. Character references are decoded after
tags are found, so `&lt;p&gt;` is text. White space inside a block becomes one space.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# fixed values: element kinds of HTML
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i img ins del kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var wbr br acronym".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head svg math object audio video canvas select button".split())
BOXES = frozenset("section div ol ul dl aside table details fieldset".split())
# elements that end an open element of the same group: <p> ends <p>, <li> ends <li>, ...
ENDS_P = frozenset("p div ul ol li dl dt dd table section article aside header footer nav main form "
                   "h1 h2 h3 h4 h5 h6 pre blockquote figure hr address fieldset".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                    r"|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PAIR = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_GAP = re.compile(r"[\x20\x09-\x0D]+")
_NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple[tuple[str, str], ...]   # (tag, words of class, id and role), outermost first
    linked: int                         # characters inside links
    tag: str
    box: int = 0                        # number of the nearest element of BOXES around it, 0: none
    top: int = 0                        # of the outermost one, inside `article` or `main` if any


def hidden(attributes: str) -> bool:
    """Whether a tag's attributes hide its element."""
    if "hidden" not in (low := attributes.lower()) and "none" not in low:
        return False
    for name, *values in _PAIR.findall(low):
        value = "".join(values)
        if (name == "hidden" or name == "aria-hidden" and value == "true"
                or name == "style" and _UNSEEN.search(value)):
            return True
    return False


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page, in page order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    marks: list[tuple[bool, int]] = []      # of the open elements: hidden, number as a box
    unseen, made, inline = 0, 0, []         # open hidden elements; hidden inline element, its depth
    linked, in_link, skipping, at = 0, 0, 0, 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not skipping and not unseen and not inline:
            parts.append(raw)
            if in_link:
                linked += len(raw)

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = _GAP.sub(" ", html.unescape("".join(parts))).strip(" ")
            if text:
                inner = max((k for k, (t, _) in enumerate(stack) if t in ("article", "main")), default=-1)
                boxes = [n for _, n in marks[inner + 1:] if n] or [0]
                out.append(Block(text, tuple(stack), linked, stack[-1][0] if stack else "",
                                 boxes[-1], boxes[0]))
            parts.clear()
        linked = 0

    def close_last() -> str:
        nonlocal unseen
        unseen -= marks.pop()[0]
        return stack.pop()[0]

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        closing, tag = m[1] == "/", m[2].lower()
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag in INLINE:
            if inline:
                inline[1] += (tag == inline[0]) * (-1 if closing else 1)
                if not inline[1]:
                    inline.clear()
            elif not closing and tag not in VOID and hidden(m[3]):
                inline += [tag, 1]
            if tag == "a":
                in_link = max(0, in_link - 1) if closing else in_link + 1
            elif tag == "br":
                add(" ")
            continue
        if tag in SKIPPED:
            if tag == "head" or skipping or not closing:
                end_block()
            skipping = max(0, skipping + (-1 if closing else 1))
            continue
        if tag == "body":
            skipping = 0
        end_block()
        in_link = 0
        inline.clear()
        if closing:
            if any(t == tag for t, _ in stack):
                while close_last() != tag:
                    pass
        elif tag not in VOID:
            if stack and (stack[-1][0] == "p" and tag in ENDS_P or stack[-1][0] == tag
                          and tag in ("li", "dt", "dd", "option", "tr", "td", "th")):
                close_last()
            names = " ".join(x for a in _ATTRIBUTE.finditer(m[3])
                             for x in _NAME.findall((a[2] or a[3] or a[4] or "").lower()))
            made += 1
            marks.append((hidden(m[3]), made * (tag in BOXES)))
            unseen += marks[-1][0]
            stack.append((tag, names))
    end_block()
    return out
