"""Main text of web pages by composite text density.

A page becomes a tree of elements. What an article never holds (menus, headers and footers of the page, sidebars, notices,
adverts, forms, scripts, styles, reader comments) is left out, by element name, role, or a word of its id or class. Over the
rest, every node has C characters, T elements, and of these LC and LT inside links; its density is

    C / T * log(C / LC * T / LT)  to the base  ln(C / nLC * LC + LC_body / C_body * C + e)

(nLC = C - LC; 0 counts as 1; on a page without any link text the base would be 1 everywhere, and the natural logarithm is taken)

and its sum that of its children's densities, where a text directly in the node counts as a child. The node with the largest
sum is the article's; the least density on its path to the body is the threshold: from the body down, in each part that
reaches it the subtree with the largest sum is kept too, so sections beside the densest one stay. A node inside ``article``
or ``main`` stands for the whole of it. All text of the kept subtrees comes out, block by block.

One page is one row from start to end: no shuffle, batches of bounded bytes, and work in proportion to a page's markup, so
lost executors cost only the pages they held.

Defined results. Null or empty html, and pages without text: empty text, 0 characters. Cut-off pages: open elements end with
the page, a cut-off tag is dropped. Blocks that appear twice are kept twice. Repeated rows give repeated rows; empty tables no
rows. Columns besides ``page_id, url, html`` are left out. ``br`` is white space; cells and list items are blocks. The
header of an article belongs to it; its footer does not.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from pricetide.llm.common import map_arrow

# Elements without an end tag; elements whose content is no markup; elements that are no running text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# Never part of an article: by element name, by role, by a word of id or class.
OUTSIDE = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form frame frameset head iframe input map menu nav noframes "
    "noscript object optgroup option script select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pagination pager popup promo promoted promotion related respond share sharing sidebar signup skyscraper social sponsor "
    "sponsored subscribe toolbar widget".split()
)
COMMENTS = frozenset("comment comments disqus respond".split())
# A word that may also name a part of an article does not count there.
IN_ARTICLE = frozenset("header notice notices banner".split())
# Start tags that end an open element of these names, unless one of the scopes lies between.
ENDS = {
    "p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th",
    "thead": "tr td th thead tbody tfoot", "tbody": "tr td th thead tbody tfoot", "tfoot": "tr td th thead tbody tfoot", "option": "option",
}
ENDS = {name: frozenset(open_.split()) for name, open_ in ENDS.items()}
SCOPE = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",))}
TABLE = frozenset(("table",))
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
P_SCOPE = frozenset("body td th li dd button article section div caption table".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?][^<>]*>""", re.S)
_CUT_OFF = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")
_MARK = re.compile(r"""(?:^|[\s"'])(id|class|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^<>]*(?:>|\Z)", re.I) for name in RAW}
_PARTS = re.compile(r"[^a-z]+")


class Node:
    """An element; ``items`` are its texts and elements in page order."""

    __slots__ = ("name", "marks", "items", "up", "chars", "linked", "tags", "links", "density", "sum")

    def __init__(self, name: str, marks: str, up: Node | None):
        self.name, self.marks, self.up, self.items = name, marks, up, []
        self.chars = self.linked = self.tags = self.links = 0
        self.density = self.sum = 0.0


def parse(html: str) -> Node:
    """The page as a tree below one unnamed node; unclosed elements end where HTML ends them."""
    root = now = Node("", "", None)
    opened: dict[str, int] = {}
    at = 0

    def shut(node: Node) -> Node:
        opened[node.name] -= 1
        return node.up

    def end_open(names: frozenset, scope: frozenset) -> None:
        """End the nearest open element of these names, and what is open in it, if no scope lies between."""
        nonlocal now
        if not any(opened.get(n) for n in names):
            return
        node, target = now, None
        while node.up is not None and node.name not in scope:
            if node.name in names:
                target = node
                # Cells end before their row does.
                if not names & {"tr", "thead", "tbody", "tfoot"}:
                    break
            node = node.up
        while target is not None and now is not target.up:
            now = shut(now)

    while True:
        token = _TOKEN.search(html, at)
        text = html[at : token.start() if token else len(html)]
        if not token:
            text = _CUT_OFF.sub("", text)
        if text:
            now.items.append(unescape(text) if "&" in text else text)
        if not token:
            return root
        at, name = token.end(), token[2]
        if not name:
            continue
        name = name.lower()
        if token[1]:
            if opened.get(name):
                while now.name != name:
                    now = shut(now)
                now = shut(now)
            continue
        if name in ENDS_P and opened.get("p"):
            end_open(ENDS["p"], P_SCOPE)
        if name in ENDS and name != "p":
            end_open(ENDS[name], SCOPE.get(name, TABLE))
        if name in ("body", "html") and opened.get(name):
            continue
        node = Node(name, token[3], now)
        now.items.append(node)
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID:
            opened[name] = opened.get(name, 0) + 1
            now = node


def _words(node: Node, inside: bool) -> set[str]:
    """Words of an element's id and class that name what no article holds. ``inside``: it is within ``article`` or ``main``."""
    found = set()
    for mark, *values in _MARK.findall(node.marks):
        value = next((v for v in values if v), "").lower()
        if mark.lower() == "role":
            found |= {"role"} & {"role" if value in ROLES else ""}
            continue
        for word in value.split():
            parts = _PARTS.split(word)
            # A name's first or last part says what it is: "ad-top", "post-comments", "cookie_notice"; not "has-ad-slot".
            found |= {parts[0], parts[-1], "".join(parts)} & WORDS
    return found - IN_ARTICLE if inside else found


def _holds_article(node: Node) -> bool:
    """If an element holds ``main``, or an ``article`` that is no reader's comment."""
    inner = _order(node)[1:]
    return any(n.name == "main" or (n.name == "article" and not _words(n, False) & COMMENTS) for n in inner) and not _words(node, False) & COMMENTS


def _pruned(root: Node) -> None:
    """Take out what is left out by element or role, then what is left out by its words."""

    def prune(goes) -> None:
        stack = [(root, False)]
        while stack:
            node, inside = stack.pop()
            keep = []
            for item in node.items:
                if type(item) is Node:
                    if goes(item, inside):
                        # What is left out still parts the text around it.
                        if item.name not in INLINE:
                            keep.append(Node("hr", "", node))
                        continue
                    stack.append((item, inside or item.name in ("article", "main")))
                keep.append(item)
            node.items = keep

    prune(lambda n, inside: n.name in OUTSIDE or (n.name == "header" and not inside and not _holds_article(n)))
    size: dict[int, int] = {}
    for node in reversed(_order(root)):
        size[id(node)] = sum(len(i.strip()) if type(i) is str else size[id(i)] for i in node.items)

    has_article = _holds_article(root)

    def worded(node: Node, inside: bool) -> bool:
        words = _words(node, inside) if node.marks and node.name not in ("html", "body", "main") else None
        if not words:
            return False
        # A wrapper named like that ("nav-open") is none if the article, or else most of the page, is in it.
        return bool(words & COMMENTS) or not (_holds_article(node) if has_article else 2 * size[id(node)] > size[id(root)])

    prune(worded)


def _order(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [item for item in reversed(node.items) if type(item) is Node]
    return out


def _weigh(nodes: list[Node], body: Node) -> None:
    """Characters, elements, densities and sums of all nodes, children first."""
    own: dict[int, list[int]] = {}
    for node in reversed(nodes):
        texts = own[id(node)] = [n for t in node.items if type(t) is str and (n := len(t.split()) and len(" ".join(t.split())))]
        node.chars += sum(texts)
        if node.name == "a":
            node.linked, node.links = node.chars, node.links + 1
        if node.up is not None:
            node.up.chars += node.chars
            node.up.linked += node.linked
            node.up.tags += node.tags + 1
            node.up.links += node.links
    ratio = body.linked / max(body.chars, 1)
    base = (lambda x: math.log(math.log(x + math.e))) if ratio else (lambda x: 1.0)
    for node in reversed(nodes):
        c, lc, t, lt = node.chars, max(node.linked, 1), max(node.tags, 1), max(node.links, 1)
        if c:
            node.density = c / t * math.log(c / lc * t / lt) / base(c / max(c - node.linked, 1) * node.linked + ratio * c)
        node.sum += sum(n * math.log(n) / base(ratio * n) for n in own[id(node)])
        if node.up is not None:
            node.up.sum += node.density


def _whole(node: Node) -> Node:
    """The outermost ``article``, or else ``main``, around a node; the node itself without one."""
    found, above = node, node
    while above is not None:
        if above.name == "article" or (above.name == "main" and found.name != "article"):
            found = above
        above = above.up
    return found


def _subtree(node: Node, body: Node) -> bool:
    while node is not None and node is not body:
        node = node.up
    return node is body


def select(root: Node) -> list[Node]:
    """The subtrees of a pruned page that hold its article, in page order."""
    nodes = _order(root)
    body = next((n for n in nodes if n.name == "body"), root)
    if body is not root and any(type(i) is str and i.strip() for n in (root, *root.items) if type(n) is Node and n.name in ("", "html") for i in n.items):
        body = root
    _weigh(nodes, body)
    inside = [n for n in _order(body) if n.chars]
    if not inside:
        return []
    best = max(inside, key=lambda n: n.sum)
    threshold, above = best.density, best
    while above is not None and above is not body:
        threshold, above = min(threshold, above.density), above.up
    threshold = min(threshold, body.density)
    kept, found = _whole(best), []
    below: dict[int, Node] = {}
    for node in reversed(inside):
        best_below = max([node, *(below[id(i)] for i in node.items if type(i) is Node and id(i) in below)], key=lambda n: n.sum)
        below[id(node)] = best_below
    stack = [body]
    while stack:
        node = stack.pop()
        if node is kept:
            found.append(node)
        elif _subtree(kept, node):
            stack += [i for i in reversed(node.items) if type(i) is Node]
        elif kept.name not in ("article", "main") and node.chars and node.density >= threshold:
            found.append(below[id(node)])
    return found


def blocks(node: Node) -> list[str]:
    """Texts of a subtree, cut where an element that is no running text begins or ends."""
    out: list[str] = []
    run: list[str] = []

    def cut() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [node]
    while stack:
        item = stack.pop()
        if type(item) is str:
            run.append(item)
        elif item is None:
            cut()
        elif item.name == "br":
            run.append(" ")
        elif item.name in INLINE:
            stack += reversed(item.items)
        else:
            cut()
            stack.append(None)
            stack += reversed(item.items)
    cut()
    return out


def main_text(html: str | None) -> str:
    """The article of a page; empty if there is none."""
    if not html:
        return ""
    root = parse(html)
    _pruned(root)
    return "\n\n".join(b for node in select(root) for b in blocks(node))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``)."""

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(html) for html in batch["html"].to_pylist()]
        columns = [batch["page_id"], batch["url"], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    chosen = pages.select("page_id", "url", "html")
    kinds = dict(chosen.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_arrow(chosen, texts, schema, text="html")
