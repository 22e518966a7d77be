"""Main text of web pages by tree scoring.

A tolerant reader builds the element tree. Boilerplate subtrees (by element,
role or hidden state, and those of reader comments by name) are cut; a subtree whose name marks boilerplate is
cut too, unless it holds HELD of the page's points, as an article within a
"widget" does. Every block with text of its own is a
paragraph with points for its length and commas; the points go to its ancestors,
less with each level, and an ancestor's sum is discounted by its link density.
The best container is kept, widened to an ancestor that holds clearly more of
the page's points, and so are its siblings that look like text. Blocks come out
in page order.

Defined results: null or empty html gives the empty text; character references
are decoded; white space within a block becomes one space; blocks are joined by
one space and nothing of the kept blocks is dropped or cut. Rows are kept one to
one and equal html gives equal text.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|--!>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split()
)
CUT_TAGS = frozenset(
    "nav header footer aside form script style noscript template iframe button select option textarea input svg canvas object embed audio video dialog menu head title map fieldset".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status".split())
#: Words of class and id names that mark reader comments.
COMMENT_NAMES = frozenset("comment comments commentlist respond disqus replies reply discussion".split())
#: Share of the page's points from which a subtree is kept whatever its name.
HELD = 0.5
#: Words of class and id names that mark what is not the article.
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense promo promotion promoted sponsor sponsored sponsors banner cookie cookies consent gdpr notice notices notification "
    "newsletter subscribe subscription signup share sharing social related recommended recommendations menu nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "footer header masthead sidebar aside rail widget widgets popup modal overlay lightbox login toolbar skip".split()
)
#: Elements that hold the article as a whole; a name does not cut them.
KEPT_TAGS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Open elements that a start tag ends: itself and these, up to a boundary.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_BOUNDS = frozenset("html body table ul ol dl select article section div main aside nav header footer form td th blockquote button".split())


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "score", "points", "first", "last", "named")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.score = self.points = 0.0
        self.first, self.last = -1, -1  # its range of blocks
        self.named = False  # as boilerplate


def parse(html: str) -> Node:
    """The element tree; end tags left out or crossed are dealt with as browsers mostly do."""
    root = here = Node("#root", "", None)
    at, lower = 0, None
    for_end: Node | None
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        name = m[2]
        if name is None:
            c = m[0]
            if c[0] != "<" or c == "<":
                here.children.append(c)
            continue
        tag = name.lower()
        if m[1]:
            if tag == "br":
                here.children.append(Node("br", "", here))
                continue
            for_end = here
            while for_end is not None and for_end.tag != tag:
                if tag in INLINE and for_end.tag in _BOUNDS:
                    for_end = None
                    break
                for_end = for_end.parent
            if for_end is not None and for_end.parent is not None:
                here = for_end.parent
            continue
        ends = _ENDS.get(tag)
        if ends:
            n = here
            while n.parent is not None and (n.tag in ends or n.tag not in _BOUNDS):
                if n.tag in ends:
                    here = n.parent
                n = n.parent
        elif tag not in INLINE and tag not in VOID or tag == "hr":
            n = here
            while n.parent is not None and n.tag not in _BOUNDS:
                if n.tag == "p" or n.tag in HEADINGS and tag in HEADINGS:
                    here = n.parent
                    break
                n = n.parent
        node = Node(tag, m[3], here)
        here.children.append(node)
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            stop = lower.find("</" + tag, at)
            if len(lower) != len(html):  # lower() may change lengths; rare
                found = re.compile("</" + tag, re.I).search(html, at)
                stop = found.start() if found else -1
            at = len(html) if stop < 0 else stop
            here = node
        elif tag not in VOID and not m[3].endswith("/"):
            here = node
        elif tag not in VOID and m[3].endswith("/") and tag not in ("path", "g", "rect", "circle", "line"):
            here = node
    return root


def _attrs(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _named(value: str, names: frozenset) -> bool:
    return any(p.lower() in names for p in _PART.findall(value))


def cut(node: Node, in_article: bool) -> bool:
    """Whether the subtree is boilerplate."""
    tag = node.tag
    if tag in CUT_TAGS:
        # an article's own header holds its title
        return not (tag == "header" and in_article)
    if not node.attrs or node.attrs.isspace() or tag in KEPT_TAGS and tag != "article":
        return False
    a = _attrs(node.attrs)
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    if a.get("role", "").lower() in CUT_ROLES:
        return True
    if tag in INLINE and tag != "span":
        return False
    names = f"{a.get('class', '')} {a.get('id', '')}" if tag != "article" else a.get("id", "")
    if _named(names, COMMENT_NAMES):
        return True
    node.named = _named(names, CUT_NAMES)
    # a piece of a line isn't weighed
    return node.named and tag == "span"


def prune(node: Node, in_article: bool = False) -> None:
    stack = [(node, in_article)]
    while stack:
        n, inside = stack.pop()
        inside = inside or n.tag in ("article", "main")
        n.children = [c for c in n.children if isinstance(c, str) or not cut(c, inside)]
        stack += [(c, inside) for c in n.children if not isinstance(c, str)]


def blocks(node: Node) -> list[tuple[Node, str, int]]:
    """(block element, its text up to the next block border, characters in links)."""
    out: list[tuple[Node, str, int]] = []
    buffer: list[str] = []
    linked = 0

    def flush(owner: Node) -> None:
        nonlocal linked
        text = _SPACE.sub(" ", unescape("".join(buffer))).strip()
        if text:
            out.append((owner, text, min(linked, len(text))))
        buffer.clear()
        linked = 0

    # (element, next child, block that owns its text, within a link)
    stack: list[list] = [[node, 0, node, False]]
    while stack:
        top = stack[-1]
        n, i, owner, link = top
        if i >= len(n.children):
            stack.pop()
            if n.tag not in INLINE:
                flush(owner)
            continue
        top[1] += 1
        c = n.children[i]
        if isinstance(c, str):
            buffer.append(c)
            if link:
                linked += len(c.strip())
        elif c.tag == "br":
            buffer.append(" ")
        elif c.tag in INLINE:
            stack.append([c, 0, owner, link or c.tag == "a"])
        elif c.tag not in VOID:
            flush(owner)
            stack.append([c, 0, c, link])
        elif c.tag == "hr":
            flush(owner)
    flush(node)
    return out


def points(text: str) -> float:
    return 1.0 + text.count(",") + min(len(text) / 100, 3.0) if len(text) >= 25 else 0.0


def _weigh(found: list[tuple[Node, str, int]]) -> list[Node]:
    """Points, scores and ranges of blocks of all elements above blocks; those elements, each once."""
    above: dict[int, Node] = {}
    for i, (node, text, _) in enumerate(found):
        p, n, level = points(text), node, 0
        while n is not None:
            if id(n) not in above:
                above[id(n)] = n
                n.score = n.points = 0.0
                n.first = i
            n.last = i + 1
            n.points += p
            # a paragraph's parent gets all, the next half, and so on
            n.score += 0.0 if level == 0 and n.tag in ("p", "pre", "li", "td", *HEADINGS) else p if level <= 1 else p / (2 if level == 2 else level * 1.5)
            n, level = n.parent, level + 1
    return list(above.values())


def _without(found: list[tuple[Node, str, int]], gone: list[Node]) -> list[tuple[Node, str, int]]:
    """Blocks that stand in none of the ranges of ``gone``."""
    edges = [0] * (len(found) + 1)
    for n in gone:
        edges[n.first] += 1
        edges[n.last] -= 1
    out, depth = [], 0
    for x, e in zip(found, edges, strict=False):
        depth += e
        if not depth:
            out.append(x)
    return out


def extract(html: str | None) -> str:
    if not html or not html.strip():
        return ""
    root = parse(html)
    prune(root)
    found = blocks(root)
    if not found:
        return ""
    named = [n for n in _weigh(found) if n.named and n.points < HELD * root.points]
    found = _without(found, named) or found
    scored = _weigh(found)
    # sums over the blocks before each: characters in links, characters, blocks with links
    sums = [(0, 0, 0)]
    for _, text, k in found:
        a, b, c = sums[-1]
        sums.append((a + k, b + len(text), c + (k > 0)))

    def over(n: Node, i: int) -> int:
        return sums[n.last][i] - sums[n.first][i]

    def free(n: Node) -> float:
        return 1 - over(n, 0) / max(1, over(n, 1))

    bonus = {"article": 1.5, "main": 1.25, "section": 1.0, "div": 1.0, "#root": 0.9, "html": 0.9, "body": 0.95}
    best = max(scored, key=lambda n: n.score * free(n) * bonus.get(n.tag, 0.9))
    if best.points == 0:
        best = max(scored, key=lambda n: (n.tag in ("article", "main"), n.tag == "body"))
    up = best
    while up.parent is not None:  # an ancestor with clearly more text, or the article around it
        up = up.parent
        if up.tag in ("article", "main") or up.points * free(up) > 1.15 * best.points and up.points > best.points:
            best = up
    keep, known = [best], {id(n) for n in scored}
    if best.parent is not None and best.tag != "body":
        for s in best.parent.children:
            if isinstance(s, str) or s is best or id(s) not in known or free(s) < 0.75:
                continue
            if s.points >= max(4.0, 0.2 * best.points) or s.tag == "p" and over(s, 1) > 80:
                keep.append(s)
    # runs of links and little else
    menus = [n for n in scored if n.tag in ("ul", "ol", "dl", "div", "table", "section") and free(n) < 0.34 and over(n, 2) >= 2]
    chosen = [x for n in sorted(keep, key=lambda n: n.first) for x in range(n.first, n.last)]
    texts = _without([(n, (i, t), k) for i, (n, t, k) in enumerate(found)], menus)
    kept = set(chosen)
    return " ".join(t for _, (i, t), _ in texts if i in kept)


def add_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of every page."""

    def make():
        def f(pages):
            return [pa.array([extract(p) for p in pages.to_pylist()], pa.string())]

        return f

    return add_columns(df, [html], [(text, "string")], make)


def page_texts(pages: DataFrame) -> DataFrame:
    return add_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
