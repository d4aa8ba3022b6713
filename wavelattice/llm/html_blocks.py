"""Leaf blocks of an HTML page with their tag paths.

A block is the text between two boundaries of block-level elements; inline elements do not cut it. The parser is forgiving
in the way browsers are: unclosed paragraphs, list items and cells end where the next one begins, unknown end tags are
ignored, and a page may stop anywhere. Scripts, styles, titles, comments and form controls hold no text.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/<>"']*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/<>"']*)([^<>]*)>""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[a-z]+")

#: Elements whose content is not text of the page; they end at their own end tag only.
OPAQUE = frozenset("script style title template noscript textarea select svg iframe object canvas math xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split())
#: What an opening tag ends, and the elements beyond which it does not reach.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"), "thead": ("tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
_LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}
_P_LIMITS = frozenset(("table", "td", "th", "caption", "button", "object", "html"))


class Block(NamedTuple):
    """Names along the path (tags, then words of classes, ids and roles as ``.word``), text, and characters within links."""

    path: tuple[str, ...]
    text: str
    linked: int


def _closing(name: str) -> re.Pattern:
    if name not in _closers:
        _closers[name] = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I)
    return _closers[name]


_closers: dict[str, re.Pattern] = {}


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    if not attributes or "=" not in attributes:
        return (tag,)
    words = [w for m in _NAMED.finditer(attributes) for w in _NAME_PARTS.findall((m[1] or m[2] or m[3] or "").lower())]
    return (tag, *("." + w for w in words[:16]))


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page that hold any text, in page order; character references are decoded, white space is one blank."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    runs: list[str] = []
    links = linked = at = 0
    page = page or ""

    def flush():
        nonlocal runs, linked
        text = " ".join("".join(runs).split()) if runs else ""
        if text:
            out.append(Block(tuple(n for _, names in stack for n in names), text, min(linked, len(text))))
        runs, linked = [], 0

    def run(text: str):
        nonlocal linked
        text = entities.unescape(text) if "&" in text else text
        runs.append(text)
        if links:
            linked += len(text)

    def pop_to(i: int):
        nonlocal links
        links -= sum(tag == "a" for tag, _ in stack[i:])
        del stack[i:]

    def end(names, limits):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                pop_to(i)
                return
            if stack[i][0] in limits:
                return

    while True:
        m = _TAG.search(page, at)
        if m is None:
            run(page[at:])
            break
        if m.start() > at:
            run(page[at:m.start()])
        at = m.end()
        slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue  # comment, doctype
        tag = name.lower()
        if tag == "br":
            runs.append(" ")
        elif slash:
            if tag in BLOCK:
                flush()
            i = next((j for j in range(len(stack) - 1, -1, -1) if stack[j][0] == tag), -1)
            if i >= 0 and tag not in BLOCK and any(t in BLOCK for t, _ in stack[i + 1:]):
                links -= tag == "a"
                del stack[i]  # an inline element that ends within a block opened after it
            elif i >= 0:
                pop_to(i)
        elif tag in OPAQUE:
            stop = _closing(tag).search(page, at)
            at = stop.end() if stop else len(page)
        else:
            if tag in BLOCK:
                flush()
                end(("p",), _P_LIMITS)
                if tag in _ENDS:
                    for _ in _ENDS[tag]:
                        end(_ENDS[tag], _LIMITS.get(tag, ("table",)))
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                stack.append((tag, _names(tag, attributes)))
                links += tag == "a"
    flush()
    return out
