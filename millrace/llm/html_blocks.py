"""Text blocks of a web page, with what its markup says of each."""

from __future__ import annotations

import html
import re

TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
WORD = re.compile(r"[a-z0-9]+")

# Element names of HTML and common names of page parts.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
TEXTLESS = frozenset("head script style noscript template title iframe object svg canvas audio video map xmp noembed noframes".split())
NAMED = frozenset("nav header footer aside form menu dialog button select textarea option datalist input".split())
ARTICLES = ("article", "main")
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
PARTS = frozenset("ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
                  "notices alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment "
                  "comments respond reply replies disqus share sharing social related recommended newsletter subscribe "
                  "signup login popup modal overlay search pagination pager toolbar widget".split())
CONTENT = frozenset("article content post main body entry story text".split())
COMMENTS = frozenset("comment comments respond reply replies disqus".split())


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)}


def is_part(tag: str, raw: str, inside: bool) -> bool:
    """Whether an element is named as a part of the page that is not its article. In an article, ``header`` holds its
    own head line."""
    if tag in NAMED:
        return not (tag == "header" and inside)
    if not raw.strip() or tag in ("html", "body"):
        return False
    found = attributes(raw)
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return True
    for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
        words = set(WORD.findall(name))
        if words & COMMENTS or words & PARTS and not words & CONTENT:
            return True
    return False


def blocks_of(page: str) -> tuple[list[str], list[bool], list[bool]]:
    """Text blocks in order, whether each lies in an article, and whether in an element that is named as another part.

    Elements without text of the page (scripts, styles, the head) give no blocks. A page part ends with its element; an
    article that begins inside an unclosed part ends it, too. Character references are decoded, white space becomes one
    space, empty blocks are left out.
    """
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    skip, depth = None, 0          # the part that is open, and its open copies
    inside = {t: 0 for t in ARTICLES}

    def level() -> int:
        return 2 if inside["article"] else 1 if inside["main"] else 0

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((-1 if skip is not None else level(), text))
        parts.clear()

    at, size = 0, len(page)
    silent = 0                     # open elements without text
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            if not silent:
                parts.append(html.unescape(page[at:]))
            break
        if not silent and m.start() > at:
            parts.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, raw = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if not closing and tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            if tag != "textarea" and skip is None and not silent:
                close()
            continue
        if silent:
            # Where a head is not closed, the body ends it.
            if tag == quiet:
                silent += -1 if closing else 1
            elif tag == "body" or tag in ARTICLES and not closing:
                silent = 0
            if silent or closing:
                continue
        elif tag in TEXTLESS and tag not in RAW:
            if not closing:
                close()
                quiet, silent = tag, 1
            continue
        if skip is not None:
            if tag not in INLINE:
                close()
            if tag in ARTICLES and not closing and not is_part(tag, raw, True) and skip not in ARTICLES:
                skip = None        # an article is never part of a menu or advert
            elif skip == "p" and tag not in INLINE and tag not in VOID and not (closing and tag == "p"):
                skip = None        # a paragraph ends where another block begins or its parent ends
            elif tag == skip:
                depth += -1 if closing else 1
                if not depth:
                    close()
                    skip = None
                continue
            else:
                continue
        if tag not in INLINE:
            close()
        if closing:
            if tag in inside and inside[tag]:
                inside[tag] -= 1
            continue
        if tag in VOID:
            continue
        if is_part(tag, raw, level() > 0):
            close()
            skip, depth = tag, 1
        elif tag in inside:
            inside[tag] += 1
    close()
    best = 2 if any(k == 2 for k, _ in blocks) else 1
    return [t for _, t in blocks], [k >= best for k, _ in blocks], [k < 0 for k, _ in blocks]
