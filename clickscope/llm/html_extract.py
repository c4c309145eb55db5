"""Main text of web pages by line-block distribution.

Markup is stripped to lines: each block of text (paragraph, heading, list item,
table cell) is one line, weighed by its length without link text.  Parts that
markup names as something else than the article (menus, page headers and
footers, sidebars, notices, adverts, forms, comments, scripts, styles) leave
empty lines in their place, and so do the borders of an article.  If the page
marks an article, its lines weigh more and all others nothing.  The weights are
summed over a sliding window of lines.  The sums surge where an article begins
and dive to nothing where it ends; what stands between a surge and a dive is
kept if the sums reach ``least`` on the way, short lines included.  In a page
without a marked article stretches that are mostly links are menus; a lighter
stretch is kept too if the parent of a line of it is a part of the page that
has a line of a kept one in it, at any depth: an advert inside the text cuts it
in two, whatever the weight of the pieces.  If none is heavy, all are kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# HTML elements by their role.
RAW = "script style noscript template textarea iframe object svg math canvas title xmp noembed noframes"
OUTSIDE = "nav aside footer form button select option dialog menu fieldset label input datalist output"
VOID = "area base br col embed hr img input link meta param source track wbr"
INLINE = ("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s samp small span "
          "strike strong sub sup time tt u var img wbr nobr")
ARTICLE = "article main"
ROLES = "navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog"

# Words of class and id that name parts outside the article.
NAMES = ("ad ads advert advertisement advertising adverts adbox banner sponsor sponsored promo promotion cookie cookies consent "
         "gdpr notice notices notification alert sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer header "
         "masthead topbar comment comments commentlist disqus reply replies respond related recommended share sharing social "
         "newsletter subscribe subscription signup login popup modal overlay toolbar pagination pager widget widgets")

# Fixed value: words that begin the class or id of an article element that is no article of its page.
TEASERS = "comment comments reply replies related recommended teaser promo sponsored sponsor ad ads advert"

_TEASERS = frozenset(TEASERS.split())
_RAW, _OUTSIDE, _VOID, _INLINE, _ARTICLE, _ROLES, _NAMES = (
    frozenset(x.split()) for x in (RAW, OUTSIDE, VOID, INLINE, ARTICLE, ROLES, NAMES))
_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?>=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?|\"[^\"]*\"?|'[^']*'?")
_SPLIT = re.compile(r"[-_]+")


def attributes(text: str) -> dict[str, str]:
    """The attributes of a start tag by lower-case name, lower-case values (none: empty); of equal names the first counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            out.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return out


def _outside(name: str, own: dict[str, str], in_article: bool) -> bool:
    """Does this start tag open a part that is not the article's text?"""
    if name in _OUTSIDE or name == "header" and not in_article:
        return True
    if name in ("html", "body") or not own:
        return False
    tokens = f"{own.get('class', '')} {own.get('id', '')}".split()
    if name in _ARTICLE:  # the article itself may be named after what else is on its page; teasers and comments are named first
        return any(_SPLIT.split(token)[0] in _TEASERS for token in tokens)
    if own.get("role") in _ROLES or "hidden" in own and name not in _INLINE or own.get("aria-hidden") == "true":
        return True
    for token in tokens:
        part = _SPLIT.split(token)
        if token in _NAMES or part[-1] in _NAMES and part[0] not in ("no", "has", "with", "without"):
            return True
        if part[0] in _NAMES and part[-1] in ("box", "wrapper", "container", "area", "section", "list", "slot", "block",
                                              "form", "bar", "inner", "content", "item", "body", "text", "card"):
            return True
    return False


def page_lines(page: str, window: int = 3) -> tuple[list[tuple[str, int, bool, int]], list[int]]:
    """Lines of a page: (text, length without links, inside a marked article, number of its block), and the parent of each block.

    A gap is ``window`` empty lines.  The page itself is block 0.
    """
    lines: list[tuple[str, int, bool, int]] = []
    blocks, parent = [0], [0]
    piece: list[str] = []
    open_tags: list[tuple[str, bool, bool]] = []  # name, outside, article
    depth: Counter = Counter()
    linked = outside = article = 0

    def end_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(piece)).split())
        if text:
            lines.append((text, max(0, len(text) - linked), article > 0, blocks[-1]))
        piece.clear()
        linked = 0

    def gap() -> None:
        end_line()
        lines.extend([("", 0, False, 0)] * window)

    at, in_head = 0, False
    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at: m.start() if m else len(page)]
        if text and not outside and not in_head:
            piece.append(text)
            if depth["a"]:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[0].startswith("<![CDATA["):
            if not outside and not in_head:
                piece.append(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name == "head":
            in_head = not closing
        elif name == "body":
            in_head = False
        if name in _RAW and not closing:
            if m[3].endswith("/") and name in ("svg", "math"):
                continue
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br" or name == "hr" or name not in _INLINE:
            if not outside:
                end_line()
        if closing:
            if depth[name]:
                while open_tags:
                    top, was_outside, was_article = open_tags.pop()
                    depth[top] -= 1
                    if top not in _INLINE:
                        blocks.pop()
                    outside -= was_outside
                    if was_article:
                        gap()
                        article -= 1
                    if was_outside and not outside:
                        gap()
                    if top == name:
                        break
        elif name not in _VOID:
            own = attributes(m[3]) if m[3] else {}
            is_outside = not in_head and _outside(name, own, article > 0)
            is_article = not is_outside and (name in _ARTICLE or "articlebody" in own.get("itemprop", "").split())
            if is_outside and not outside or is_article:
                gap()
            open_tags.append((name, is_outside, is_article))
            if name not in _INLINE:
                parent.append(blocks[-1])
                blocks.append(len(parent) - 1)
            depth[name] += 1
            outside += is_outside
            article += is_article
    end_line()
    return lines, parent


def surges(weights: list[int], window: int) -> list[tuple[int, int, int]]:
    """(surge, dive, highest sum): the stretches of lines between which a whole window weighs nothing."""
    sums = [sum(weights[max(0, i - window + 1): i + 1]) for i in range(len(weights))]
    out, begin = [], None
    for i, total in enumerate([*sums, 0]):
        if total and begin is None:
            begin = i
        elif not total and begin is not None:
            end = i
            while not weights[end - 1]:  # the window has run past the last line
                end -= 1
            out.append((begin, end, max(sums[begin:i])))
            begin = None
    return out


def main_text(page: str | None, window: int = 3, least: int = 80) -> str:
    """The article's text: blocks in page order, joined by one space (none: empty)."""
    lines, parent = page_lines(page or "", window)
    marked_page = any(marked for _, _, marked, _ in lines)
    weights = [(n + least if marked else 0) if marked_page else n for _, n, marked, _ in lines]
    found = surges(weights, window)
    if not marked_page:  # what is mostly links is a menu
        found = [(a, b, top) for a, b, top in found if 2 * sum(weights[a:b]) >= sum(len(text) for text, *_ in lines[a:b])]
    kept = [s for s in found if s[2] >= least] or found
    if not marked_page and len(kept) < len(found):
        around = {0}  # the blocks of the kept lines and all blocks around them
        for a, b, _ in kept:
            for text, _, _, block in lines[a:b]:
                while text and block not in around:
                    around.add(block)
                    block = parent[block]
        heavy = set(kept)
        kept = [s for s in found if s in heavy
                or any(lines[i][3] in around or parent[lines[i][3]] in around for i in range(s[0], s[1]) if lines[i][0])]
    return " ".join(text for a, b, _ in kept for text, *_ in lines[a:b] if text)


def extract(page: Column, window: int = 3, least: int = 80) -> Column:
    """Main text of a column of whole HTML pages (null, empty or markup only: empty)."""
    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), window, least) for p in pages], pa.string())
    return of(page)
