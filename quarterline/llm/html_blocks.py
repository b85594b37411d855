"""HTML to leaf blocks: text, tag path, link share.  A small forgiving reader for one page.

A block is the text between two block-level tags.  Inline tags and ``br`` do
not end a block.  Scripts, styles, comments, the page's title and form controls
give no text; formulas, drawings and the text given in place of embedded things
do.  An unclosed element ends where HTML ends it: ``p`` at the next block,
list items, rows and cells at their next sibling, anything at its parent's end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # per element: the tag, then its class, id and role words
    linked: float  # share of the characters inside links


UNSEEN = "script|style|textarea|title"
# What follows a tag's name: a quote opens a value only right after "="; elsewhere it is a character like any other.
_REST = r"(?:=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+)?+|[^>=]++)*+"
# Elements nested deeper than this stand on the path of the last one that counts, as in browsers.
DEPTH = 512
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<unseen>{UNSEEN})(?=[\s/>]){_REST}(?:(?<=/)>|>(?P<inner>.*?)(?:</(?P=unseen)(?=[\s/>])[^>]*>|\Z))"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_REST})>"
    r"|<[!?/][^>]*>?"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
# Behind the last ">" no tag can end, so none is looked for.
_TAIL = re.compile(r"<!--.*|<!\[CDATA\[(?P<cdata>.*)|<[!?/].*|(?P<text>[^<]+|<)(?P<tag>(?!))?(?P<inner>(?!))?", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role|type)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_ANY_ATTR = re.compile(r"([^\s>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_MAY_HIDE = re.compile(r"hidden|none", re.I)
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr "
                   "audio canvas iframe math object svg video "
                   "annotation maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace "
                   "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
                   "circle defs desc ellipse foreignobject g line lineargradient path polygon polyline rect stop symbol text textpath "
                   "tspan use".split())
SPACED = frozenset("br desc img mtd text".split())  # begin a new word
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element that ends when one of these begins, and where the search for it stops.
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}


def _names(tag: str, attrs: str) -> tuple[str, ...]:
    found = [tag]
    for m in _ATTR.finditer(attrs):
        found += _NAME.findall((m[2] or m[3] or m[4] or "").lower())
    return tuple(found)


def _hidden(tag: str, attrs: str) -> bool:
    if tag == "select":
        return True
    if not attrs or not _MAY_HIDE.search(attrs):
        return False
    for m in _ANY_ATTR.finditer(attrs):
        name, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style" and _NOT_SHOWN.search(value):
            return True
    return False


def _tokens(page: str) -> Iterator[re.Match]:
    last, at = page.rfind(">"), 0
    while at < len(page):
        m = (_TOKEN if at <= last else _TAIL).match(page, at)
        yield m
        at = m.end()


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []  # tag, names, hidden
    pieces: list[str] = []
    path: tuple[str, ...] = ()
    linked = total = hidden = links = 0  # the last two count open elements

    def flush() -> None:
        nonlocal pieces, linked, total
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, path, linked / max(1, total)))
            pieces = []
        linked = total = 0

    def end(at: int) -> None:
        nonlocal hidden, links
        if any(s[0] not in INLINE for s in stack[at:]):
            flush()
        for tag, _, unseen in stack[at:]:
            hidden -= unseen
            links -= tag == "a"
        del stack[at:]

    for m in _tokens(page):
        text = m["text"] or (m["cdata"] if m["cdata"] is not None else "")
        if m["inner"] and m["unseen"].lower() == "title" and any(s[0] == "svg" for s in stack):
            text = f" {m['inner']} "  # of a drawing, not of the page
        if text:
            if hidden:
                continue
            if not pieces:
                if text.isspace():
                    continue
                path = tuple(n for s in stack[:DEPTH] for n in s[1])
            pieces.append(text)
            n = len(text)
            total += n
            if links:
                linked += n
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    end(i)
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag not in INLINE:
            flush()
            for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph and an open heading's inline parts
                if stack[i][0] == "p":
                    end(i)
                    break
                if stack[i][0] not in INLINE:
                    break
            ended, stop = ENDED_BY.get(tag, (None, None))
            if ended:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in stop:
                        break
                    if stack[i][0] in ended:
                        end(i)
                        break
        elif tag in SPACED and pieces:
            pieces.append(" ")
        attrs = m["attrs"]
        if tag not in VOID and not attrs.endswith("/"):
            stack.append((tag, _names(tag, attrs) if attrs else (tag,), _hidden(tag, attrs)))
            hidden += stack[-1][2]
            links += tag == "a"
    flush()
    return out
