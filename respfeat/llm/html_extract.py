"""Main text of web pages by scoring the tree of elements.

A page is cut into tags and text in one pass and built into a tree of block elements;
tags that a browser would close (paragraphs, list items, cells) are closed. Elements that
are never part of an article (menus, page headers, footers, asides, forms, scripts,
hidden ones, and those whose class, id or role says advert, sidebar, notice, comment and
the like) are left out first. Then every block of text passes points to its ancestors,
for its length and its commas, less for those further up; the sum of an element is
discounted by the share of its text that stands in links. The best element is widened to
the ``article`` or ``main`` that holds it. Otherwise siblings with a good part of its score, or
paragraphs of plain prose beside it, are kept with it. All blocks inside are kept, but
for lists of nothing but links.

A block is the text between two borders of block elements; a table row is one block.
Character references are decoded once, white space (Unicode's too) becomes one space.

Rows are independent: Spark deals them, a task holds one batch. Time and memory are linear
in the page, whatever it nests.

Defined results: NULL and empty html, and pages without text, give an empty text. Repeated
rows give a row each, a NULL id stays NULL. Broken markup is read as far as it goes: an
unclosed comment or script takes the rest of the page, as in browsers; an unclosed quote ends with
its tag; ``<`` before anything but a name is text. An empty table gives an empty result. Further columns of the input are not used.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respfeat.llm.common import table

# Names of elements in the HTML standard, by what they do.
_VOID = frozenset("area base br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup td th time tt u var wbr".split()
)
_NEVER = frozenset(
    "aside audio button canvas datalist dialog embed footer form frameset head iframe map menu nav noembed noframes noscript "
    "object optgroup option script select style svg template textarea title video xmp".split()
)
_MAIN = frozenset(["article", "main"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag closes: open elements of these names, up to the nearest border.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "option": (("option",), ("select",)),
}
#: Words of a class, id or role that tell what is not the article.
_STRONG = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars aside "
    "footer foot footers nav navbar navigation menu menus menubar breadcrumb breadcrumbs toc cookie cookies consent gdpr notice notices "
    "notification announcement disclaimer alert popup modal overlay newsletter subscribe subscription signup share sharing social "
    "widget widgets pagination pager skip toolbar complementary contentinfo search dialog tags hidden".split()
)
_OTHERS_TEXT = frozenset("comment comments commentlist disqus replies reply related recommended".split())
_WEAK = frozenset("header masthead".split())
_PLAIN_PREFIX = frozenset("has with no without".split())

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in _RAW}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_COMMAS = re.compile("[,，、،]")

#: Points of a block: one if it is a sentence's length, one per comma, up to three for length.
SENTENCE, LENGTH_STEP, LENGTH_POINTS = 25, 100, 3
MAIN_POINTS = 25
#: A sibling needs this part of the best score, and so many points; prose beside it this length.
SIBLING_SHARE, SIBLING_POINTS, SIBLING_PROSE = 0.2, 10.0, 80
#: A list, of three links or more, with this share of its text in links is a menu.
LINKS, LINK_SHARE = 3, 0.75
_LISTS = frozenset("ul ol div dl table section p".split())
#: Elements that are blocks of text themselves, not containers.
_NO_CONTAINER = _HEADINGS | frozenset("p li tr dt dd figcaption caption".split())


class _Node:
    """A block element, or unwanted text within a line."""

    __slots__ = ("name", "parent", "main", "out", "soft", "score", "size", "links", "n_links", "holds_main", "prose")

    def __init__(self, name: str, parent: _Node | None, main: bool = False, out: bool = False, soft: bool = False) -> None:
        self.name, self.parent, self.main, self.out, self.soft = name, parent, main, out, soft
        self.score = 0.0
        self.size = self.links = self.n_links = self.prose = 0
        self.holds_main = False


class _Open(NamedTuple):
    """An open element: the node that its text belongs to, and what kind of border it is."""

    name: str
    node: _Node
    block: bool
    #: The line around unwanted text, which goes on after it.
    held: list | None = None


def _labels(attributes: dict) -> tuple[bool, bool, bool, bool]:
    """(unwanted whatever it holds, unwanted by its label, weakly so, hidden) by class, id, role and style."""
    comments = strong = weak = False
    for key in ("class", "id", "role"):
        for label in (attributes.get(key) or "").split():
            words = [w.lower() for w in _WORDS.findall(label)]
            if words and words[0] in _PLAIN_PREFIX:
                continue
            comments = comments or not _OTHERS_TEXT.isdisjoint(words)
            strong = strong or not _STRONG.isdisjoint(words)
            weak = weak or not _WEAK.isdisjoint(words)
    style = (attributes.get("style") or "").replace(" ", "").lower()
    hidden = "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true" or "display:none" in style
    return comments, strong, weak, hidden


def _attributes(page: str, at: int) -> tuple[dict, int]:
    """The attributes of a tag from here on, and the position after its ``>``."""
    out: dict = {}
    n = len(page)
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            end = page.find(">", at)
            return out, n if end < 0 else end + 1
        name = m.group(1).lower()
        if name not in out:
            value = next((g for g in m.groups()[1:] if g is not None), "")
            out[name] = html.unescape(value) if "&" in value else value
        at = m.end()


class _Page:
    """Builds the tree of a page and its blocks: (node, text)."""

    def __init__(self) -> None:
        self.root = _Node("", None)
        self.nodes = [self.root]
        self.open = [_Open("", self.root, True)]
        self.counts: dict[str, int] = {}
        self.blocks: list[tuple[_Node, str]] = []
        self.parts: list[str] = []
        self.link = False
        self.linked = self.n_links = 0

    def text(self, data: str) -> None:
        if data:
            if "&" in data:
                data = html.unescape(data)
            self.parts.append(data)
            if self.link:
                self.linked += sum(map(len, data.split()))

    def border(self) -> None:
        """The text since the last border is a block of the innermost open element."""
        words = "".join(self.parts).split()
        if words:
            node, text = self.open[-1].node, " ".join(words)
            self.blocks.append((node, text))
            node.size += len(text)
            node.links += min(self.linked, len(text))
            node.n_links += self.n_links
            sentence = len(text) >= SENTENCE
            if sentence and 2 * self.linked < len(text):
                node.prose += len(text)
            points = sentence + len(_COMMAS.findall(text)) + min(len(text) / LENGTH_STEP, LENGTH_POINTS)
            node.score += points * (1 - min(1.0, self.linked / len(text)))
        self.parts = []
        self.linked = self.n_links = 0

    def pop(self, depth: int) -> None:
        """Close what is open beyond this depth."""
        while len(self.open) > depth:
            top = self.open[-1]
            if top.block or top.held is not None:
                self.border()
                self.link = False
            self.open.pop()
            self.counts[top.name] -= 1
            if top.held is not None:
                self.parts = top.held

    def close_open(self, names: tuple, borders: tuple) -> None:
        """Close the innermost open element of these names, unless a border comes first."""
        if not any(self.counts.get(x) for x in names):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].name
            if name in names:
                self.pop(depth)
                return
            if name in borders:
                return

    def inside(self, names: frozenset) -> bool:
        return any(self.counts.get(x) for x in names)

    def start(self, name: str, attributes: dict) -> None:
        if name in ("html", "body"):
            return
        if name in _VOID:
            if name in ("br", "hr"):
                self.parts.append(" ")
                if name == "hr":
                    self.border()
            return
        if name in ("td", "th"):
            self.parts.append(" ")
        block = name not in _INLINE
        if block and self.counts.get("p"):
            self.close_open(("p",), ("table", "button", "object"))
        if name in _HEADINGS:
            self.close_open(tuple(_HEADINGS), ("table", "div", "section", "article"))
        if name in _CLOSES:
            self.close_open(*_CLOSES[name])
        comments, strong, weak, hidden = _labels(attributes) if attributes else (False, False, False, False)
        role = (attributes.get("role") or "").lower()
        main = name in _MAIN or role == "main" or attributes.get("itemprop") == "articleBody"
        out, soft = hidden or comments or name in _NEVER, False
        if not out and strong and name != "main" and role != "main":
            out = soft = True
        if not out and (weak or name == "header" or role == "banner"):
            out = soft = not self.inside(_MAIN)
        if not out and name == "article" and self.counts.get("article"):
            # An article within an article is a comment on it, says the standard.
            out = soft = True
        soft = soft or (name == "form" and not (hidden or comments))
        self.counts[name] = self.counts.get(name, 0) + 1
        top = self.open[-1].node
        # Cells are parts of their row's block.
        if (block and name not in ("td", "th")) or (block and out):
            self.border()
            self.link = False
            self.nodes.append(_Node(name, top, main, out, soft))
            self.open.append(_Open(name, self.nodes[-1], True))
        elif out:
            self.nodes.append(_Node(name, top, False, True))
            self.open.append(_Open(name, self.nodes[-1], False, self.parts))
            self.parts = []
        else:
            if name == "a" and "href" in attributes:
                self.link = True
                self.n_links += 1
            self.open.append(_Open(name, top, False))

    def end(self, name: str) -> None:
        if name == "br":
            self.parts.append(" ")
        elif not self.counts.get(name):
            if name == "p":
                self.border()
        else:
            inline = name in _INLINE
            for depth in range(len(self.open) - 1, 0, -1):
                if self.open[depth].name == name:
                    if name == "a":
                        self.link = False
                    self.pop(depth)
                    return
                if inline and self.open[depth].block:
                    return


def _read(page: str) -> _Page:
    out = _Page()
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            out.text(page[at:])
            break
        m = _TAG.match(page, lt)
        if m is None:
            follows = page[lt + 1 : lt + 2]
            if follows not in ("!", "?", "/"):
                out.text(page[at : lt + 1])
                at = lt + 1
                continue
            out.text(page[at:lt])
            if page.startswith("<!--", lt):
                short = next((s for s in ("<!-->", "<!--->") if page.startswith(s, lt)), None)
                end = lt + len(short) - 3 if short else page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        out.text(page[at:lt])
        name = m.group(1).lower()
        attributes, at = _attributes(page, m.end()) if page[m.end() : m.end() + 1] != ">" else ({}, m.end() + 1)
        if page[lt + 1] == "/":
            out.end(name)
        elif name in _RAW:
            end = _RAW_END[name].search(page, at)
            if end is None:
                at = n
            else:
                close = page.find(">", end.end())
                at = n if close < 0 else close + 1
        else:
            out.start(name, attributes)
    out.pop(1)
    out.border()
    return out


def _left(page: _Page) -> list[_Node]:
    """The nodes that are not left out. An element that is unwanted by its label only, or a form,
    stays if it holds the page's main element or nearly all of its prose."""
    prose = {id(x): x.prose for x in page.nodes}
    for x in reversed(page.nodes):
        if x.parent is not None:
            prose[id(x.parent)] += prose[id(x)]
            x.parent.holds_main |= x.holds_main or (x.main and not x.out)
    total, stay, left = prose[id(page.root)], set(), []
    for x in page.nodes:
        wraps = x.soft and (x.holds_main or (not page.root.holds_main and 10 * prose[id(x)] > 9 * total))
        if (x.parent is None or id(x.parent) in stay) and (not x.out or wraps):
            stay.add(id(x))
            left.append(x)
    return left


def main_text(page: str) -> str:
    """The article of a page: its blocks, joined by empty lines."""
    tree = _read(page)
    nodes = _left(tree)
    size = {id(x): x.size for x in nodes}
    links = {id(x): x.links for x in nodes}
    n_links = {id(x): x.n_links for x in nodes}
    # Points: all to the element itself and its parent, half to the next, two thirds less with each step beyond.
    own = {id(x): x.score for x in nodes}
    near = dict.fromkeys(own, 0.0)
    far = dict.fromkeys(own, 0.0)
    for x in reversed(nodes):
        if x.parent is not None:
            k, up = id(x), id(x.parent)
            near[up] += own[k]
            far[up] += near[k] / 2 + far[k] / 3
            for sums in (size, links, n_links):
                sums[up] += sums[k]

    def score(x: _Node) -> float:
        k = id(x)
        if not size[k]:
            return 0.0
        return (own[k] + near[k] + far[k] + MAIN_POINTS * x.main) * (1 - links[k] / size[k])

    def menu(x: _Node) -> bool:
        k = id(x)
        return x.name in _LISTS and n_links[k] >= LINKS and links[k] > LINK_SHARE * size[k]

    menus: set = set()
    for x in nodes:
        if (x.parent is not None and id(x.parent) in menus) or menu(x):
            menus.add(id(x))
    best = max((x for x in nodes if x.name not in _NO_CONTAINER and id(x) not in menus), key=score, default=tree.root)
    whole: _Node | None = best
    while whole is not None and not whole.main:
        whole = whole.parent
    keep = {id(whole or best)}
    if whole is None and best.parent is not None:
        enough = max(SIBLING_POINTS, SIBLING_SHARE * score(best))
        for x in nodes:
            if x.parent is best.parent and id(x) not in menus:
                k = id(x)
                prose = x.name == "p" and size[k] > SIBLING_PROSE and 4 * links[k] < size[k]
                if prose or x.name == "h1" or (x.name not in _HEADINGS and score(x) >= enough):
                    keep.add(k)
    for x in nodes:
        if x.parent is not None and id(x.parent) in keep:
            keep.add(id(x))
    keep -= menus
    return "\n\n".join(text for node, text in tree.blocks if id(node) in keep)


def _extract(batches):
    for b in batches:
        texts = [main_text(p) if p else "" for p in b["html"].to_pylist()]
        yield pa.record_batch(
            [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
