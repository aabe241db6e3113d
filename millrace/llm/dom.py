"""Blocks of a web page: pieces of text with the path of structural elements above them."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var label output meter progress picture".split()
)
# Elements that never hold an article's text.
DROPPED_TAGS = frozenset(
    "head title nav aside footer form script style noscript template iframe svg button select option optgroup textarea "
    "dialog menu object canvas audio video map fieldset datalist".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
# Words of class and id that mark what surrounds an article.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored sponsors nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside cookie cookies consent notice gdpr "
    "popup modal overlay disclaimer topbar newsletter subscribe subscription signup login share sharing social comment comments commentlist "
    "disqus respond reply replies related recommended widget toolbar pager pagination search form skip".split()
)
# A name that starts so describes the layout around the part that it names.
NEGATING = frozenset("has with without no is".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("ul ol dl table body article section div main aside nav footer form td th li".split())
MAX_LEVELS = 24  # deeper elements count as the one at this depth


@dataclass
class _Element:
    tag: str
    path: str
    noise: bool
    landmark: str
    inline: bool
    before: list[str] = field(default_factory=list)  # what stands before an inline element, to go on after it
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    """``blocks``: path, text, whether a marked element is around it, the nearest article or main element."""

    blocks: list[tuple[str, str, bool, str]]
    styles: list[tuple[str, str]]  # path of an element and its children, runs of equal ones once


def _label(tag: str, attributes: dict[str, str]) -> tuple[str, bool]:
    names: list[str] = []
    marked = False
    for token in (attributes.get("class", "") + " " + attributes.get("id", "")).lower().split():
        words = _NAMES.findall(token)  # digits, which may change from page to page, are left out
        names += words
        marked |= bool(words) and words[0] not in NEGATING and not DROPPED_NAMES.isdisjoint(words)
    return ".".join([tag, *names[:4]]), marked


def parse(source: str) -> Page:
    blocks: list[tuple[str, str, bool, str]] = []
    styles: list[tuple[str, str]] = []
    stack = [_Element("", "", False, "", False)]
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            top = stack[-1]
            blocks.append((top.path, text, top.noise, top.landmark))

    def close() -> None:
        flush()
        gone = stack.pop()
        pieces.extend(gone.before)
        if gone.children:
            styles.append((gone.path, " ".join(gone.children)))

    at, n = 0, len(source)
    while at < n:
        token = _TOKEN.match(source, at)
        at = token.end()
        if token["text"] is not None:
            pieces.append(entities.unescape(token["text"]))
            continue
        if token["cdata"] is not None:
            pieces.append(token["cdata"])
            continue
        if token["tag"] is None:
            continue
        tag, end = token["tag"].lower(), bool(token["end"])
        if end:
            if tag in INLINE and not any(e.tag == tag and e.inline for e in stack):
                continue
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag != tag:
                if tag in _SAME and stack[depth].tag in ("ul", "ol", "dl", "table"):
                    depth = 0  # an end tag does not reach out of a list
                depth -= 1
            if depth > 0:
                while len(stack) > depth:
                    close()
            elif tag not in INLINE:
                flush()
            continue
        if tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        rest = token["rest"]
        attributes = {}
        if rest and rest != "/":
            for a in _ATTRIBUTE.finditer(rest):
                attributes.setdefault(a[1].lower(), entities.unescape(a[2] or a[3] or a[4] or ""))
        label, named = _label(tag, attributes)
        noise = (
            named
            or tag in DROPPED_TAGS
            or attributes.get("role", "").lower() in DROPPED_ROLES
            or "hidden" in attributes
            or (not stack[-1].landmark and (tag == "header" or "header" in label.split(".")[1:]))
        )
        if tag in ("body", "html", "article", "main") and not (tag == "article" and "comment" in label):
            noise = False  # a class of the page as a whole says nothing about its text
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = stop.end() if stop else n
            continue
        inline = tag in INLINE
        if inline and not noise:
            continue
        if not inline:
            if tag in _CLOSES_P:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == "p":
                        while len(stack) > depth:
                            close()
                        break
                    if stack[depth].tag in _SCOPE:
                        break
            if tag in _SAME:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag in _SAME[tag]:
                        while len(stack) > depth:
                            close()
                        break
                    if stack[depth].tag in ("ul", "ol", "dl", "table", "body"):
                        break
        before = [*pieces, " "] if inline else []
        pieces[:] = [] if inline else pieces
        flush()
        top = stack[-1]
        path = top.path if len(stack) > MAX_LEVELS or inline else f"{top.path}>{label}"
        landmark = tag if tag == "article" or (tag == "main" and not top.landmark) else top.landmark
        if not inline and (not top.children or top.children[-1] != label):
            top.children.append(label)
        if not rest.endswith("/") or tag not in ("path", "use"):
            stack.append(_Element(tag, path, noise or top.noise, landmark, inline, before))
    flush()
    while len(stack) > 1:
        close()
    flush()
    return Page(blocks, styles)
