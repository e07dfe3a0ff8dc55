"""Main text of web pages by composite text density.

The page is read into a tree of elements: raw elements (script, style, ...) and
comments leave no text, void elements have no content, and start tags close the
elements that cannot hold them (a paragraph ends where the next block starts).
For every element the density is its characters per tag, lessened where much of
its text stands in links:

    (C / T) * log_b((C * T) / (L * TL)),  b = ln(C / N * L + LB / CB * C + e)

with C characters and T tags below, L characters and TL tags of links, N
characters outside links, and LB / CB the share of link characters of the body.
An element's density sum adds up the densities of its children. The threshold
is the least density on the path from the body to its element of largest
density sum. Of every block element that reaches it, the element of largest
density sum in it is main text; elements within others are part of those.
Boilerplate (menus, headers and footers outside the article,
side columns, notices, adverts, forms, reader comments; told by element name,
role, whole id, and classes that are a marker or a known form of one) is taken
out before densities are summed, so none of it counts. Headings are not told by
class and id, nor is anything in pre and code, nor inline elements in an article
or main element. A main element inside an ``article`` or ``main`` element gives
that whole element, and a title in it stays, as do figures, captions, formulas
and the text that stands in for media.

The text is that of the main elements in page order: character references decoded (each
text between two tags by itself), white space inside a block turned into one space and trimmed, blocks joined by one
space in page order; nothing is cut. A null or empty page, or one without text,
gives the empty text. Truncated and ill-formed markup is read as far as it
goes. Repeated rows are read alike; other columns are carried along.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Elements of forms, menus and side matter, which hold no main text.
BOILERPLATE = frozenset(
    "nav aside footer form button select option fieldset input dialog menu head".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
ADVERT = r"ads?|advert\w*|adbox|adsense|sponsor(?:s|ed|ship)?|promo(?:s|tion|tions)?|cookies?|consent|gdpr|popup|modal"
MARKER = (
    rf"(?:{ADVERT}|banner|notice|newsletter|subscribe|subscription|comments?|disqus|replies|respond|sidebar|side|nav|navbar|navigation|menu|"
    r"breadcrumbs?|footer|masthead|related|recommend(?:ed|ations?)?|share|sharing|social|widget|toolbar|login|signup|pager|pagination)"
)
# What a class name may hold besides a marker: 'site-nav' and 'related-posts' are forms of one, 'related-work' is not.
_WITH = (
    r"(?:site|page|main|global|primary|secondary|top|bottom|left|right|header|bar|box|block|wrap|wrapper|container|inner|outer|area|section|"
    r"list|item|items|links?|buttons?|icons?|posts?|articles|stories|slot|unit|form|panel|overlay|column|col|mobile|desktop|sticky|[0-9]+)"
)
MARKED = re.compile(rf"(?:{_WITH}[_-]+)*{MARKER}(?:[_-]+(?:{MARKER}|{_WITH}))*")
MARKED_ID = re.compile(MARKER)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a start tag closes: the open element of a name, up to the elements that shield it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul body".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|aria-hidden|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parent", "children", "boilerplate", "outer", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, boilerplate: bool = False) -> None:
        self.name, self.parent, self.children, self.boilerplate = name, parent, [], boilerplate
        # The outermost article or main element it is, or is in.
        self.outer = (parent and parent.outer) or (self if name in ("article", "main") else None)


class _Open:
    """The elements that are open, and how many of each name, so that none is searched for in vain."""

    def __init__(self, root: Node) -> None:
        self.stack, self.names = [root], Counter()

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.names[node.name] += 1

    def cut(self, k: int) -> None:
        for n in self.stack[k:]:
            self.names[n.name] -= 1
        del self.stack[k:]

    def any(self, *names: str) -> bool:
        return any(self.names[n] for n in names)

    def close(self, wanted: frozenset | set, shields: frozenset | set | None) -> None:
        """Close the innermost open element of the wanted names, unless a shield (None: any block) lies in between."""
        if not self.any(*wanted):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.stack[k].name
            if shields is not None and name in shields:
                return
            if name in wanted:
                self.cut(k)
                return
            if shields is None and name not in INLINE:
                return


def _boilerplate(name: str, attributes: str, held: _Open) -> bool:
    if name in BOILERPLATE:
        return True
    if name == "header" and not held.any("article", "main"):
        return True
    if name in ("body", "html", "article", "main"):
        return False
    marked = False
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        kind = m[1].lower()
        if kind == "role" and value in ROLES or kind == "aria-hidden" and value == "true":
            return True
        if kind in ("class", "id"):
            names, pattern = (value.split(), MARKED) if kind == "class" else ([value.strip()], MARKED_ID)
            marked = marked or any(pattern.fullmatch(x) for x in names)
    if not marked or name in HEADINGS or held.any("pre", "code"):
        return False
    return not (name in INLINE and held.any("article", "main"))


def tree(page: str) -> Node:
    """Elements and their texts, whose character references are decoded text by text."""
    root = Node("html", None)
    held = _Open(root)
    stack, at, size = held.stack, 0, len(page)
    body = None
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if not held.names[name]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    # An inline end tag does not close the block round it.
                    held.cut(k)
                    break
                if name in INLINE and stack[k].name not in INLINE:
                    break
            continue
        if name in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name == "html" or name == "body" and body is not None:
            continue
        if name in ENDS_PARAGRAPH:
            held.close({"p"}, None)
        if name in CLOSES:
            held.close(*CLOSES[name])
        if name == "body":
            held.cut(1)
        node = Node(name, stack[-1], _boilerplate(name, m[3], held))
        stack[-1].children.append(node)
        if name == "body":
            body = node
        if name not in VOID and not m[3].endswith("/"):
            held.push(node)
    return root


def _measure(root: Node) -> Node:
    """Set counts, densities and density sums; the body or what stands for it."""
    order, body = [root], root
    for node in order:
        order.extend(c for c in node.children if isinstance(c, Node) and not c.boilerplate)
        if node.name == "body":
            body = node
    for node in reversed(order):
        node.chars, node.tags, node.link_chars, node.link_tags = 0, 0, 0, 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(_SPACE.sub(" ", c).strip())
            elif not c.boilerplate:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + (c.name == "a")
        if node.name == "a":
            node.link_chars = node.chars
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(order):
        c, t, links, link_tags = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(node.chars - node.link_chars, 1)
        base = math.log(c / plain * node.link_chars + share * c + math.e)
        ratio = c * t / (links * link_tags)
        node.density = c / t * (math.log(ratio) / math.log(base) if base > 1 and ratio > 0 else math.log(ratio) if ratio > 0 else 0.0)
        node.total = sum(x.density for x in node.children if isinstance(x, Node) and not x.boilerplate)
    return body


def main_nodes(root: Node) -> list[Node]:
    """The main elements, none inside another, in page order."""
    body = _measure(root)
    below = [body]
    for node in below:
        below.extend(c for c in node.children if isinstance(c, Node) and not c.boilerplate)
    richest = {}  # the element of largest density sum in each; the outer one of equals
    for node in reversed(below):
        inner = [richest[c] for c in node.children if isinstance(c, Node) and not c.boilerplate]
        richest[node] = max([node, *inner], key=lambda n: n.total)
    threshold, node = body.density, richest[body]
    while node is not body:
        threshold, node = min(threshold, node.density), node.parent
    least = threshold - 1e-9 * abs(threshold)
    chosen = [richest[n] for n in below if n.density >= least and n.chars and (n is body or n.name not in INLINE)]
    if not any(n.chars for n in chosen):
        chosen = [max(below, key=lambda n: n.chars)]
    picked = {_lifted(n) for n in set(chosen)}
    out, work = [], [root]
    while work:
        node = work.pop()
        if node in picked:
            out.append(node)
        else:
            work.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _lifted(node: Node) -> Node:
    """The outermost article or main element round an element, else the block it stands in."""
    chosen = node.outer or node
    while chosen.parent is not None and chosen.name in INLINE:
        chosen = chosen.parent
    return chosen


def text_of(node: Node) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        if text := _SPACE.sub(" ", "".join(run)).strip():
            blocks.append(text)
        run.clear()

    work: list = [node]
    while work:
        n = work.pop()
        if n is None:
            close()
        elif isinstance(n, str):
            run.append(n)
        elif not n.boilerplate or n is node:
            if n.name not in INLINE:
                close()
                work.append(None)
            work.extend(reversed(n.children))
    close()
    return " ".join(blocks)


def extract(page: str | None) -> str:
    if not page or not page.strip():
        return ""
    return " ".join(t for t in map(text_of, main_nodes(tree(page))) if t)


def with_text(pages: DataFrame, page: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the main text in column ``to``."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([extract(p.as_py()) for p in column], pa.string())

    return pages.withColumn(to, run(F.col(page)))
