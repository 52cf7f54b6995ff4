"""Main text of HTML pages by tag-path ratios.

A page is read once into blocks of text, each with the path of block tags from the root to it. Text length and
punctuation are summed by path, so that all paragraphs of an article speak for each other, however short one is. The
ratios per block are smoothed along the page, multiplied, and held against a threshold; the paths above it are the
content, and the smallest element around most of their text is the article. What says by tag, class, id or role
that it is no article text is left out before.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from flowmill.llm.batches import per_text

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z!?/][^>]*+(?:>|\Z)""", re.DOTALL
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.IGNORECASE)
_QUOTED = re.compile(r"""(?<==)\s*(?:"[^"]*"|'[^']*')""")
_LINK = re.compile(r"""(?:^|["'\s/])href\s*=""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")

# What tags are, by the HTML standard; own choice of the words that name no article text.
_BLOCKS = frozenset(
    "html body main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption "
    "thead tbody tfoot tr td th blockquote pre figure figcaption form fieldset legend address details summary hgroup "
    "center dir menu hr search dialog".split()
)
_RAW = frozenset("script style noscript template textarea iframe svg math object select title head xmp noframes".split())
_OUTSIDE = frozenset("nav footer aside form dialog menu button search".split())
_HOLDERS = frozenset("html body main article".split())
_SELF_CLOSING = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "thead", "tbody", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
_OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner sidebar "
    "sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist "
    "commentary disqus replies reply cookie cookies consent gdpr notice notices notification notifications alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager copyright disclaimer topbar skip contentinfo complementary search toc".split()
)
_PAGE_NAMES = frozenset(["header"])  # no article text outside articles


@dataclass
class _Element:
    tag: str
    parent: int
    outside: bool  # names itself as no article text
    holder: bool  # is or contains an article or main part


@dataclass
class _Block:
    element: int
    path: tuple[str, ...]
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _outside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _OUTSIDE or tag == "header" and not in_article:
        return True
    if not attributes or tag in _HOLDERS:
        return False
    if _HIDDEN.search(attributes):
        return True
    for m in _NAMES.finditer(attributes):
        words = set(_WORDS.findall((m[2] or m[3] or m[4] or "").lower()))
        if words & _OTHER_NAMES or not in_article and words & _PAGE_NAMES:
            return True
    return False


def blocks(page: str) -> tuple[list[_Element], list[_Block]]:
    """Elements in page order and the blocks of text in them; scripts, styles, comments and the head are skipped."""
    elements = [_Element("", -1, False, False)]
    stack, found = [0], []
    block: _Block | None = None
    at, inline_links, inside_articles = 0, 0, 0
    link_depth: int | None = None

    def close(count: int) -> None:
        nonlocal block, inside_articles, inline_links
        block = None
        for i in stack[len(stack) - count :]:
            inside_articles -= elements[i].tag in ("article", "main")
        del stack[len(stack) - count :]
        # a link ends with the block that holds it, one without an end tag with any block
        if link_depth is None or len(stack) < link_depth:
            inline_links = 0

    def put(text: str) -> None:
        nonlocal block
        if block is None:
            if not text.strip():
                return
            block = _Block(stack[-1], tuple(elements[i].tag for i in stack[1:]))
            found.append(block)
        block.parts.append(text)
        if inline_links:
            block.linked += len(text.strip())

    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _RAW and not m[1] and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            if tag == "head":  # pages may leave out its end tag
                body = re.compile(r"<body\b", re.IGNORECASE).search(page, at)
                end_at = min([x.end() if x is end else x.start() for x in (end, body) if x], default=None)
                at = at if end_at is None else end_at
            else:
                at = len(page) if end is None else end.end()
            continue
        if tag == "a":
            inline_links = int(not m[1] and not m[3].endswith("/") and _LINK.search(_QUOTED.sub("''", m[3])) is not None)
            after = _ANCHOR.search(page, at) if inline_links else None
            link_depth = len(stack) if after and after[1] else None
        elif tag in ("br", "img", "wbr", "input"):
            if tag == "br" and block is not None:
                block.parts.append(" ")
        elif tag in _BLOCKS or tag == "button":
            block = None
            if m[1]:
                depth = next((d for d, i in enumerate(reversed(stack), 1) if elements[i].tag == tag), 0)
                if depth:
                    close(depth)
                continue
            if elements[stack[-1]].tag == "p" and tag != "button":
                close(1)
            if tag in _SELF_CLOSING:
                ends, stops = _SELF_CLOSING[tag]
                last = 0
                for d, i in enumerate(reversed(stack), 1):
                    if elements[i].tag in stops:
                        break
                    if elements[i].tag in ends:
                        last = d
                if last:
                    close(last)
            if tag in ("html", "body") and any(elements[i].tag == tag for i in stack) or tag == "hr":
                continue
            article = tag in ("article", "main")
            elements.append(_Element(tag, stack[-1], _outside(tag, m[3], inside_articles > 0), article))
            inside_articles += article
            if article:
                for i in stack:
                    elements[i].holder = True
            stack.append(len(elements) - 1)
    for b in found:
        b.text = " ".join(entities.unescape("".join(b.parts)).split())
    return elements, [b for b in found if b.text]


def _smoothed(values: Sequence[float], kernel: Sequence[float] = (0.25, 0.5, 0.25)) -> list[float]:
    """The values with their neighbours mixed in; the ends count for what is missing beside them."""
    reach = len(kernel) // 2
    padded = [values[0]] * reach + list(values) + [values[-1]] * reach
    return [sum(k * padded[i + j] for j, k in enumerate(kernel)) for i in range(len(values))]


def extract(page: str | None, share: float = 0.3, most: float = 0.7) -> str:
    """The main text: its blocks in page order, one per line; empty if there is none.

    ``share`` is the part of the mean fused ratio (weighted by text) that a path must reach, ``most`` the part of the
    selected text that an element must hold to be taken for the article.
    """
    elements, found = blocks(page or "")
    outside = [False] * len(elements)
    for i, e in enumerate(elements):  # parents come first
        outside[i] = e.parent >= 0 and outside[e.parent] or e.outside and not e.holder
    found = [b for b in found if not outside[b.element]]
    if not found:
        return ""
    size, marks, number, linked = (defaultdict(int) for _ in range(4))
    for b in found:
        size[b.path] += len(b.text)
        marks[b.path] += len(_PUNCTUATION.findall(b.text)) + 1
        number[b.path] += 1
        linked[b.path] += b.linked
    menu = {p for p in size if linked[p] > 0.6 * size[p]}
    lengths = _smoothed([0.0 if b.path in menu else size[b.path] / number[b.path] for b in found])
    points = _smoothed([0.0 if b.path in menu else marks[b.path] / number[b.path] for b in found])
    fused, weight = defaultdict(float), sum(size.values())
    for b, x, y in zip(found, lengths, points, strict=True):
        fused[b.path] += (x * y) ** 0.5 / number[b.path]
    mean = sum(fused[p] * size[p] for p in size) / weight
    content = {p for p in size if fused[p] >= share * mean and p not in menu}
    if not content:  # of a page of links only, these are the text
        content, menu = set(size), set()
    held = defaultdict(int)
    for b in found:
        if b.path in content:
            i = b.element
            while i >= 0:
                held[i] += len(b.text)
                i = elements[i].parent
    root = 0
    for i, e in enumerate(elements):  # parents come first, so this goes inward
        if e.parent == root and held[i] >= most * held[0] and e.tag not in _LEAVES:
            root = i
    wide = elements[root].tag in ("", "html", "body")

    def within(i: int) -> bool:
        while i >= 0 and i != root:
            i = elements[i].parent
        return i == root

    own = [b for b in found if within(b.element)]
    # in an article that is more than links, lists of links are references
    references = not wide and 2 * sum(b.linked for b in own) < sum(len(b.text) for b in own)

    def kept(b: _Block) -> bool:
        if b.path in menu and not references:
            return False
        return b.path in content or not wide or elements[b.element].tag in _HEADINGS

    return "\n".join(b.text for b in own if kept(b))


_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: Never an article by themselves.
_LEAVES = _HEADINGS | frozenset("p li dt dd td th tr tbody thead caption blockquote pre figcaption ul ol dl".split())


def main_text(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Per row ``text`` and ``n_chars`` (its code points), from the whole page.

    Null, empty and textless pages give an empty text. Pages of any length are read whole; an unclosed tag at the end
    is no text. Repeated rows stay; kept columns named like a result give way.
    """

    def start():
        def compute(values: pa.Array):
            texts = [extract(v) for v in values.to_pylist()]
            return texts, [len(t) for t in texts]

        return compute

    return per_text(pages, html, keep, "text string, n_chars long", start)
