"""HTML main-text extraction by composite text density.

A page is parsed into a small tree of elements. Elements that never hold main
text (scripts, menus, forms, adverts, reader comments, ...) are left out by
tag, role or class. For every element left, the link-adjusted characters per
tag are computed::

    C chars, T tags, LC chars in links, LT links of the element's subtree
    density = C / T * log(C / LC * T / LT, base ln(LC * C / (C - LC) + C * body LC / body C + e))

(counts of 0 taken as 1). An element's density sum adds up its children's
densities. The element with the largest sum is the core of the text. From it
the result climbs towards the body while all that an ancestor adds is text of
the page's own: headings, and elements whose density reaches the threshold,
the least density on the path from the body to the core. The core is searched
on the whole page, whatever elements it declares. ``article`` and ``main`` only
add to what density chose: if the core lies in such an element, the climb starts
from the whole (outermost) element, and the page's other outermost ones are
taken too unless all their text is links. Elements without text decide nothing:
text outside an empty ``article`` is found as on any other page.

Time and memory grow with the page's length, however deeply it is nested.

The text is those subtrees' blocks in page order, joined by one line feed.
Character references are decoded; white space inside a block becomes one
space; ``br`` is white space. Nothing else is dropped or capped.

Defined results: null, empty or text-free HTML gives the empty text;
truncated markup is closed at its end; repeated rows are extracted row by
row; other columns pass through and give way to ``text`` and ``n_chars``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import array_slices, packed, text_of, with_results

BATCH_BYTES = 4_000_000  # of HTML: what one step of a task holds, but for a longer page

# Fixed values (the HTML standard's element kinds and common page vocabulary).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes plaintext textarea title noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED_TAGS = frozenset(
    "head script style noscript template nav footer aside menu form button select input textarea label fieldset dialog"
    " iframe object embed applet svg canvas audio video noembed noframes xmp plaintext title search".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promotion banner"
    " nav navbar navigation menu menubar topbar breadcrumb breadcrumbs pagination pager masthead header footer sidebar"
    " aside widget related recommended share sharing social cookie cookies consent gdpr notice notices notification"
    " alert popup modal overlay newsletter subscribe subscription signup login form search comment comments reply"
    " replies respond disqus discussion skip toolbar".split()
)
#: A class with one of these words is the text's own; only adverts and comments go in spite of them.
TEXT_WORDS = frozenset("article content main post entry story body text page wrapper container".split())
ALWAYS_DROPPED = frozenset(
    "ad ads advert adverts advertisement advertising sponsored comment comments reply replies disqus sidebar cookie cookies".split()
)
#: Start tags that end an open element of the second set, looked for up to an element of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
ENDS_P = BLOCK - {"body", "html", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend", "dt", "dd"} | {"li", "dt", "dd"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
P_SCOPE = frozenset("html body table td th caption button object article section div main aside".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"  # comment
    r"|<[!?][^>]*>?"  # doctype, declaration
    r"|</([a-zA-Z][^\s/>]*)[^>]*>?"  # end tag
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|=|["'])*)>?""",  # start tag
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Node:
    """An element: its children in order, elements and pieces of text."""

    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "links", "density", "dropped")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []


def _words(value: str) -> set[str]:
    return {word.lower() for word in _WORD.findall(value)}


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _dropped(tag: str, source: str, inside_text: bool) -> bool:
    """True for an element that never holds main text. inside_text: it stands in an article or main element."""
    if tag in DROPPED_TAGS or tag == "header" and not inside_text:
        return True
    if tag in ("html", "body", "article", "main") and "comment" not in source.lower():
        return False
    if not source.strip(" /\t\r\n\f"):
        return False
    attributes = _attributes(source)
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or "display:none" in style or attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    words = _words(attributes.get("class", "") + " " + attributes.get("id", ""))
    if words & TEXT_WORDS:
        return bool(words & ALWAYS_DROPPED)
    return bool(words & DROPPED_WORDS)


class _Open:
    """The elements that are open, the page's own first, and where those of each tag stand.

    Every question about what encloses the present place is answered from the
    places of a few tags, so parsing takes no walk to the root.
    """

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {root.tag: [0]}

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element with one of the tags; -1 for none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def first_after(self, tags: Iterable[str], place: int) -> int:
        """The place of the outermost such element beyond a place; -1 for none."""
        after = []
        for tag in tags:
            places = self.places.get(tag, [])
            at = bisect_right(places, place)
            after += places[at : at + 1]
        return min(after, default=-1)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Ends the element at a place and all in it; the page's own stays open."""
        while len(self.nodes) > max(place, 1):
            self.places[self.nodes.pop().tag].pop()


def parse(html: str) -> Node:
    """The page's tree without dropped elements' text."""
    root = Node("html", None)
    opened = _Open(root)
    at, raw = 0, ""  # raw: the open element whose content is not markup
    while at < len(html):
        if raw:
            end = re.compile(rf"</{raw}(?=[\s/>]|$)", re.I).search(html, at)
            at, raw = end.start() if end else len(html), ""
            opened.close(len(opened.nodes) - 1)
            continue
        start = html.find("<", at)
        if start < 0:
            _add_text(opened.nodes[-1], html[at:])
            break
        if start > at:
            _add_text(opened.nodes[-1], html[at:start])
        token = _TOKEN.match(html, start)
        if not token:
            _add_text(opened.nodes[-1], "<")
            at = start + 1
            continue
        at = token.end()
        if end_tag := token[1]:
            if (place := opened.last([end_tag.lower()])) > 0:
                opened.close(place)
        elif token[2]:
            tag = token[2].lower()
            if _start(opened, tag, token[3] or "") and tag in RAW_TEXT:
                raw = tag
    return root


def _add_text(node: Node, text: str) -> None:
    if not node.dropped:
        node.children.append(unescape(text) if "&" in text else text)


def _start(opened: _Open, tag: str, source: str) -> bool:
    """Adds the element of a start tag. True if it is open then."""
    if tag in CLOSES:
        closed, limit = CLOSES[tag]
        if (place := opened.first_after(closed, opened.last(limit))) > 0:
            opened.close(place)
    elif tag in ENDS_P and (place := opened.last(("p",))) > 0 and place > opened.last(P_SCOPE):
        opened.close(place)
    if tag == "html":
        return False
    node = opened.nodes[-1]
    child = Node(tag, node, node.dropped or _dropped(tag, source, opened.last(("article", "main")) >= 0))
    node.children.append(child)
    if tag in VOID or source.rstrip().endswith("/") and tag not in BLOCK | RAW_TEXT:
        return False
    opened.push(child)
    return True


def _postorder(root: Node) -> list[Node]:
    """The elements that are kept, children before parents."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.dropped:
            order.append(node)
            stack.extend(child for child in node.children if isinstance(child, Node))
    return order[::-1]


def _measure(order: list[Node]) -> None:
    """Counts of every subtree, then every density."""
    for node in order:
        node.chars = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.tags = node.link_chars = node.links = 0
        for child in node.children:
            if isinstance(child, Node) and not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.links += child.links
        if node.tag == "a":
            node.link_chars, node.links = node.chars, node.links + 1
    body = order[-1]
    body_links = body.link_chars / max(body.chars, 1)
    for node in order:
        chars, tags = node.chars, max(node.tags, 1)
        link_chars, links = max(node.link_chars, 1), max(node.links, 1)
        base = math.log(link_chars * chars / max(chars - link_chars, 1) + body_links * chars + math.e)
        node.density = chars / tags * max(math.log(chars / link_chars * tags / links), 0.0) / math.log(base) if chars else 0.0


def _density_sum(node: Node) -> float:
    return sum(child.density for child in node.children if isinstance(child, Node) and not child.dropped)


def main_nodes(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order; none without text."""
    order = _postorder(root)
    _measure(order)
    if not root.chars:
        return []
    outer = _outermost(root, lambda n: n.tag in ("article", "main"))
    declared = {id(n) for n in outer}
    core = max(order, key=lambda n: (_density_sum(n), n.density))
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    held = next((at for at, n in enumerate(path) if id(n) in declared), 0)
    at = held
    while at + 1 < len(path) and all(_own_text(child, threshold) for child in path[at + 1].children if child is not path[at]):
        at += 1
    tops = {id(path[at])}
    if id(path[held]) in declared:
        tops |= {id(o) for o in outer if o.chars > o.link_chars}
    return _outermost(root, lambda n: id(n) in tops)


def _own_text(child: Node | str, threshold: float) -> bool:
    if isinstance(child, str):
        return True
    return child.dropped or not child.chars or child.tag in HEADINGS or child.density >= threshold


def _outermost(root: Node, wanted: Callable[[Node], bool]) -> list[Node]:
    """The kept elements that are wanted and lie in no other such element, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if wanted(node):
            found.append(node)
        else:
            stack.extend(child for child in reversed(node.children) if isinstance(child, Node) and not child.dropped)
    return found


def blocks(top: Node) -> list[str]:
    """The texts of the subtree's blocks in page order."""
    found: list[str] = []
    open_block: list[str] = []

    def close() -> None:
        if text := " ".join("".join(open_block).split()):
            found.append(text)
        open_block.clear()

    stack: list[Node | str | None] = [top]
    while stack:
        item = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            open_block.append(item)
        elif not item.dropped:
            if item.tag == "br":
                open_block.append(" ")
            if item.tag in BLOCK:
                close()
                stack.append(None)
            stack.extend(reversed(item.children))
    close()
    return found


def main_text(html: str) -> str:
    """The main text of one page."""
    return "\n".join(block for top in main_nodes(parse(html)) for block in blocks(top))


def extractor():
    """A Spark function HTML -> main text."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            yield pa.array([main_text(html.as_py() or "") for html in batch], pa.string())

    return texts


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars`` (its code points)."""
    rows = pages.select(packed(pages).alias("row"), text_of(html).alias("html"))
    texts = rows.select("row", extractor()("html").alias("main"))
    return with_results(texts, "row", {"text": F.col("main"), "n_chars": F.char_length("main").cast("long")})
