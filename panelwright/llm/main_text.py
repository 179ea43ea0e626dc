"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelwright.llm.common import python_batches

# Element names by their role in HTML. Annotations are sources of a formula, which browsers do not show.
RAW = frozenset("script style noscript template textarea iframe svg object title xmp noembed noframes annotation-xml annotation".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math semantics menclose merror mfenced mfrac mi mn mo mover mpadded mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split())
CHROME = frozenset("nav footer aside button select option menu head input datalist".split())
# Chrome as well, unless they wrap the article.
WRAPPERS = frozenset("form fieldset dialog header".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos banner cookie "
    "cookies cc consent gdpr popup modal overlay newsletter subscribe subscription signup login sidebar "
    "widget widgets related recommended recommendations menu nav navbar navigation navi breadcrumb breadcrumbs pagination "
    "pager masthead topbar footer foot copyright disclaimer sharing comment comments respond "
    "reply replies feedback disqus toolbar form hidden".split())
# Words that name parts of an article just as well.
TWOFOLD_WORDS = frozenset(
    "header share social side rail legal notice notices alert search discussion skip promotion".split())
NEUTRAL_WORDS = frozenset(
    "site page main top bottom left right primary secondary global list area box container wrapper wrap section block item "
    "items user users reader readers inner outer body content slot bar buttons links panel group row col column post posts".split())
KEPT_ROOTS = frozenset("html body main".split())
NAMED, MAYBE = 0.1, 0.7      # what class names leave of a ratio: the whole name is chrome, or some of its words
SECOND = 0.69                # all words of the name have a second meaning
LINKED = 0.9                 # share of link text from which a block is a menu entry
CLOSED_BY_SIBLING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}

NAME = re.compile(r"[A-Za-z][^\s/><]*")
# What follows a tag's name: quoted values may hold anything, and a new tag ends an unclosed one.
REST = re.compile(r"""((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""")
ENDS = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW}
ATTRIBUTE = re.compile(
    r"""(?<![^\s"'>/=])([^\s"'>/=]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))|(\bhidden\b)""", re.S)
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


class Element:
    """A node of the page. Numbers are in page order, so the nodes below one are those from ``number`` to ``last``."""

    __slots__ = ("name", "parent", "number", "last", "chrome", "path", "wraps", "doubt", "inside", "link", "block", "length",
                 "article", "outer", "gone", "least", "first_block", "last_block")

    def __init__(self, name: str, parent: "Element | None", number: int, path: int):
        self.name, self.parent, self.number, self.last, self.path = name, parent, number, number, path
        self.chrome = False               # dropped with all below it
        self.wraps = False                # dropped, unless it wraps the article
        self.doubt = 1.0                  # by its own class names
        self.inside = name in ARTICLES or parent is not None and parent.inside
        self.link = name == "a" or parent is not None and parent.link
        self.block = parent.block if name in INLINE else self
        self.length = self.article = 0    # text in it, and of that inside article and main elements
        self.outer = 0                    # 1 inside an article or main element, 2 if something named like chrome is between
        self.gone, self.least = False, 1.0
        self.first_block, self.last_block = -1, -2

    def holds(self, other: "Element | None") -> bool:
        return other is not None and self.number <= other.number <= self.last


ARTICLES = ("article", "main")


@dataclass
class Block:
    home: Element
    parts: list[str] = field(default_factory=list)
    shares: dict[int, list[int]] = field(default_factory=lambda: defaultdict(lambda: [0, 0]))   # path: length, punctuation
    linked: int = 0              # characters inside of links
    doubt: float = 1.0
    elements: list[Element] = field(default_factory=list)    # of the page's first block: its article and main elements

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def scan(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of what a page is made of: ``text``, ``open`` and ``close``.

    Comments, declarations and elements that are not text are passed over. One pass: a tag without an end stops at the
    next tag.
    """
    at, size, last = 0, len(html), html.rfind(">")
    while at < size:
        start = html.find("<", at)
        if start < 0:
            start = size
        if start > at:
            yield "text", html[at:start], ""
        if start == size:
            return
        at = start + 1
        mark = html[at:at + 1]
        if mark == "!" or mark == "?":
            if html.startswith("!--", at):
                end = html.find("-->", at + 3)
                at = size if end < 0 else end + 3
            elif html.startswith("![CDATA[", at):
                end = html.find("]]>", at)
                end = size if end < 0 else end
                yield "text", html[at + 8:end].replace("&", "&amp;"), ""
                at = end + 3
            elif start < last:
                at = html.index(">", at) + 1
            else:
                yield "text", "<", ""
            continue
        ending = mark == "/"
        name = NAME.match(html, at + ending)
        if name is None or start > last:
            yield "text", "<", ""
            continue
        rest = REST.match(html, name.end())
        if rest:
            attributes, at = rest[1], rest.end()
        else:
            after = html.find("<", name.end())
            after = size if after < 0 else after
            end = html.find(">", name.end(), after)
            attributes, at = (html[name.end():after], after) if end < 0 else (html[name.end():end], end + 1)
        tag = name[0].lower()
        if tag in RAW:
            if not ending and not (tag == "svg" and attributes.endswith("/")):
                closing = ENDS[tag].search(html, at)
                at = closing.end() if closing else size
            continue
        yield "close" if ending else "open", tag, attributes


def is_chrome(name: str, attributes: str) -> bool:
    """Menus, footers, sidebars and what is not shown, by element, role or style."""
    if name in CHROME:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, *values, hidden in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if hidden or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key == "role" and value in CHROME_ROLES:
            return True
    return False


def doubt_of(name: str, attributes: str, inside_article: bool) -> float:
    """Evidence of classes and ids against an element: a factor of its ratio.

    A name like ``sidebar`` or ``cookie-notice``, all of whose words are those of chrome or of layout, counts in full;
    one that has such a word beside others (``has-sidebar``), or only words with a second meaning, counts little.
    Headers inside of an article are part of it.
    """
    if not attributes or name in KEPT_ROOTS:
        return 1.0
    out = 1.0
    for key, *values, _ in ATTRIBUTE.findall(attributes):
        if key.lower() not in ("class", "id"):
            continue
        for one in "".join(values).lower().split():
            words = set(re.findall(r"[a-z]+", one))
            if inside_article:
                words.discard("header")
            sure, twofold = words & CHROME_WORDS, words & TWOFOLD_WORDS
            whole = not words - sure - twofold - NEUTRAL_WORDS
            if sure and whole:
                return NAMED
            if twofold and whole and not sure:
                out = min(out, SECOND)
            elif sure and name != "article":
                out = min(out, MAYBE)
    return out


def blocks_of(html: str) -> list[Block]:
    """Text blocks in page order, without those inside page chrome. Malformed markup closes as browsers close it.

    Classes and ids drop nothing here: they leave their doubt on the elements. Elements may be nested to any depth.
    """
    top = Element("", None, 0, 0)
    elements, stack, out, block = [top], [top], [], None
    paths: dict[tuple[int, str], int] = {}
    places: dict[str, list[int]] = defaultdict(list)     # where in the stack elements of a name are open

    def nearest(names) -> int:
        return max((places[n][-1] for n in names if places[n]), default=0)

    def close(names, stop=()) -> None:
        """Pop to the nearest open element of ``names``, unless one of ``stop`` is nearer."""
        k = nearest(names)
        if k and k >= nearest(stop):
            for e in stack[k:]:
                places[e.name].pop()
            del stack[k:]

    for kind, name, attributes in scan(html):
        here = stack[-1]
        if kind == "text":
            if here.chrome:
                continue
            plain = unescape(name) if "&" in name else name
            bare = len(plain.strip())
            if block is None:
                if not bare:
                    continue
                block = Block(here.block)
                out.append(block)
            block.parts.append(plain)
            share = block.shares[here.path]
            share[0] += bare
            share[1] += len(PUNCTUATION.findall(plain))
            if here.link:
                block.linked += bare
            continue
        inline = name in INLINE
        if name == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if not inline:
            block = None
        if kind == "close":
            close((name,), INLINE_STOPS if inline else ())
            continue
        if name in VOID:
            continue
        if not inline:
            close(("p",), PARAGRAPH_STOPS)
            if name in CLOSED_BY_SIBLING:
                close(CLOSED_BY_SIBLING[name], LIST_STOPS)
        if attributes.endswith("/") and name not in ("p", "div", "span", "article", "section", "li", "a"):
            continue
        parent = stack[-1]
        e = Element(name, parent, len(elements), paths.setdefault((parent.path, name), len(paths) + 1))
        e.chrome = parent.chrome or is_chrome(name, attributes)
        e.wraps = name in WRAPPERS and not (name == "header" and parent.inside)
        e.doubt = doubt_of(name, attributes, parent.inside)
        places[name].append(len(stack))
        elements.append(e)
        stack.append(e)
    return settled([b for b in out if b.text], elements)


INLINE_STOPS = ("p", "div", "li", "td", "article", "section", "body")
PARAGRAPH_STOPS = ("table", "div", "article", "section", "li", "td", "th", "body", "main", "aside", "nav", "footer", "button")
LIST_STOPS = ("ul", "ol", "dl", "table")


def settled(blocks: list[Block], elements: list[Element]) -> list[Block]:
    """Blocks with the doubt of all elements around them, without those in forms and page headers.

    An element that wraps the article is neither dropped nor doubted: one with at least half of the text of ``article``
    and ``main`` elements, or with most of the page's text. Names with a second meaning (``discussion``) are doubted in
    full outside of the article elements, where these hold most of the text. Sums go up and decisions go down the tree
    in one pass each.
    """
    total = articles = 0
    for e in elements[1:]:
        above = e.parent.outer
        # Article elements that are comments or adverts by their names do not count as articles.
        e.outer = (1 if e.name in ARTICLES and e.doubt > NAMED else 0) if not above else 1 if above == 1 and e.doubt > NAMED else 2
    for b in blocks:
        n = len(b.text)
        total += n
        b.home.length += n
        if b.home.outer == 1:
            articles += n
            b.home.article += n
    for e in reversed(elements[1:]):
        e.parent.length += e.length
        e.parent.article += e.article
        e.parent.last = max(e.parent.last, e.last)

    def spared(e: Element) -> bool:
        if articles and 2 * e.article >= articles:
            return True
        sure = e.wraps or e.doubt <= NAMED
        return e.length >= 0.8 * total and not articles if sure else 2 * e.length >= total

    for e in elements[1:]:
        e.gone, e.least = e.parent.gone, e.parent.least
        if (e.wraps or e.doubt < 1) and not spared(e):
            e.gone |= e.wraps
            second = e.doubt == SECOND and not e.outer and 2 * articles >= total
            e.least = min(e.least, NAMED if second else e.doubt)
    out = [b for b in blocks if not b.home.gone]
    for k, b in enumerate(out):
        b.doubt, e = b.home.least, b.home
        e.first_block, e.last_block = (e.first_block if e.first_block >= 0 else k), k
    for e in reversed(elements[1:]):
        if e.first_block >= 0:
            up = e.parent
            up.first_block = e.first_block if up.first_block < 0 else min(up.first_block, e.first_block)
            up.last_block = max(up.last_block, e.last_block)
    for b in out[:1]:
        b.elements = [e for e in elements if e.name in ARTICLES and e.first_block >= 0]
    return out


def link_share(block: Block) -> float:
    return block.linked / max(1, sum(n for n, _ in block.shares.values()))


def ratios(blocks: list[Block]) -> np.ndarray:
    """Fused tag-path ratio of each block.

    Per root-to-leaf path: text length and punctuation over the number of nodes with that path. A block's ratios are
    those of its paths, weighted by their text; both series are smoothed over neighbours and multiplied. The third
    series, text outside of links, is a block's own: it lowers blocks more than half of which are links, down to 0.
    """
    nodes, length, marks = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in blocks:
        for path, (n, p) in b.shares.items():
            nodes[path] += 1
            length[path] += n
            marks[path] += p
    series = np.zeros((2, len(blocks)))
    for k, b in enumerate(blocks):
        total = max(1, sum(n for n, _ in b.shares.values()))
        for path, (n, _) in b.shares.items():
            series[0, k] += n / total * length[path] / nodes[path]
            series[1, k] += n / total * marks[path] / nodes[path]
    kernel = np.array([0.1, 0.2, 0.4, 0.2, 0.1])
    smooth = [np.convolve(np.pad(s, 2, mode="edge"), kernel, "valid") for s in series]
    apart = np.minimum(1.0, 2 - 2 * np.array([link_share(b) for b in blocks]))
    return smooth[0] * (1 + smooth[1]) * apart


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, one per line.

    Every block whose fused ratio passes the threshold is content, wherever it stands. ``article`` and ``main`` elements
    raise the ratio by their share of the text, class names of chrome lower it. Beside these blocks stand the headings
    over them, short blocks between two of them in one parent, and the rest of an ``article`` or ``main`` element
    most of whose text has passed.
    """
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    size = np.array([len(b.text) for b in blocks])
    doubt = np.array([b.doubt for b in blocks])
    total = size.sum()
    # Blocks inside one element follow each other.
    ranges = {(e.first_block, e.last_block + 1) for e in blocks[0].elements}
    named = [r for r in (a + np.flatnonzero(doubt[a:z] > NAMED) for a, z in sorted(ranges)) if len(r)]
    prior = np.ones(len(blocks))
    for inside in named:
        prior[inside] = np.maximum(prior[inside], 1 + size[inside].sum() / total)
    doubt = doubt / doubt.max()
    plain = ratios(blocks) * prior
    fused = plain * doubt
    sure = doubt == 1
    chosen = (fused >= fused[sure].std() * 0.5) & (fused > 0)
    if not chosen[sure].any():
        chosen |= sure
    # A doubted block has to stand out from what passed without doubt.
    chosen &= sure | (fused >= np.median(plain[chosen & sure]) * 0.5)

    member = chosen.copy()
    for inside in named:
        if 2 * size[inside][chosen[inside]].sum() >= size[inside].sum():
            member[inside[doubt[inside] >= doubt[inside].max()]] = True
    places = np.flatnonzero(member)
    for i, j in zip([-1, *places], places):
        gap = range(i + 1, j)
        if not gap:
            continue
        over = blocks[j].home.parent
        if over is None:
            continue
        if i >= 0 and (beside := blocks[i].home.parent) is not None and (beside.holds(over) or over.holds(beside)):
            common = beside if beside.holds(over) else over
            member[[k for k in gap if doubt[k] >= min(doubt[i], doubt[j]) and common.holds(blocks[k].home)]] = True
        # Headings over the content, with what stands below them: the nearest one, and others above up to a menu.
        top, menu = j, False
        for k in reversed(gap):
            up = blocks[k].home.parent
            heads = up is not None and (up.holds(over) or i < 0 and up.parent is not None and up.parent.holds(over))
            if re.fullmatch(r"h[1-6]", blocks[k].home.name) and heads and doubt[k] == 1:
                if menu and top < j:
                    break
                top = k
            menu |= link_share(blocks[k]) >= LINKED
        member[[k for k in range(top, j) if doubt[k] == 1 and (link_share(blocks[k]) < LINKED or k == top)]] = True
    return "\n".join(b.text for b, m in zip(blocks, member) if m)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; null html is empty, empty pages give empty text.

    A page is judged by itself, so no group forms and repeated rows get equal results; other columns are ignored and
    an empty table gives an empty result. Whole pages are read, in batches bounded by bytes.
    """
    python_batches(pages.sparkSession, 1000, "4m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
