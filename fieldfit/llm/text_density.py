"""Main text of web pages by composite text density.

The page is read into a tree. For every node the composite text density compares
its characters with its tags, adjusted for how much of either belongs to links;
the density sum of a node adds up the densities of its children. Among the nodes
that are at least as dense as the thinnest node on the path from the densest-summed
node up to the body, the subtree with the largest density sum is the main text.

Parts that by element, role or class name are no article text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are
set aside before the densities are taken, and so are blocks made of links outside of
an article or main element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed lists: elements whose content is never text, elements without content,
# elements that are no article text, elements that break a line of text, and words
# of a class, id or role that mark boilerplate.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "noembed", "noframes", "xmp", "title", "svg", "math", "object", "canvas", "video", "audio"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "label", "head"}
BLOCK = {
    "address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | ASIDE
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MARKED = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr"
    r"|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|nav|navbar|navigation|menu|breadcrumb|breadcrumbs"
    r"|sidebar|side|aside|complementary|related|recommended|recommendations|share|sharing|social|comment|comments|disqus|reply|replies"
    r"|respond|responses|footer|masthead|contentinfo|header|pagination|pager|toolbar|widget|search|skip|tags|outbrain|taboola)(?:$|[^a-z])"
)
# Of these, names that parts of an article have as well: inside one they count only
# where they are the whole name of a container.
ORDINARY = {"side", "search", "tags", "header", "share", "sharing", "related", "alert", "skip", "widget", "reply", "respond", "responses"}
TEXT_TAGS = HEADINGS | {"p", "li", "dt", "dd", "td", "th", "blockquote", "pre", "figure", "figcaption"}
# An end tag that is missing is supplied where one of these starts.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "select", "article", "section", "div"}

TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*(?=>|$)|[^>]*)(?:>|$)""", re.DOTALL)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)

LINK_SHARE = 0.5  # a block with this share of its characters in links is a menu ...
LINK_COUNT = 2  # ... if it has this many links


class Node:
    """An element: its parts in page order are nodes and strings."""

    __slots__ = ("tag", "parts", "aside", "chars", "link_chars", "tags", "link_tags", "density", "total", "parent", "within")

    def __init__(self, tag: str, parent: Node | None, aside: bool = False):
        self.tag, self.parent, self.aside, self.parts = tag, parent, aside, []


def boilerplate(tag: str, attributes: str, within: list[Node]) -> bool:
    """Whether an element is set aside for its name or what it is called."""
    if tag in ASIDE:
        return True
    if tag == "header":
        return not any(n.tag in ("article", "main") for n in within)
    if attributes and tag not in ("html", "body", "article", "main"):
        if HIDDEN.search(attributes):
            return True
        inside = any(n.tag in ("article", "main") for n in within)
        for _, *value in NAMES.findall(attributes):
            for name in "".join(value).lower().split():
                found = set(marked(name))
                if found - ORDINARY or found and not inside or name in ORDINARY - {"header"} and tag not in TEXT_TAGS:
                    return True
    return False


def marked(name: str) -> Iterator[str]:
    """The marking words of a class, id or role."""
    at = 0
    while m := MARKED.search(name, at):
        yield re.sub("[^a-z]", "", m[0])
        at = m.end() - (m[0][-1] not in LETTERS)  # the sign between two words belongs to both


def parse(html: str) -> Node:
    """The tree of a page; missing end tags are supplied as browsers do for the usual cases."""
    root = Node("html", None)
    stack = [root]
    at = 0
    while at < len(html):
        m = TOKEN.search(html, at)
        upto = m.start() if m else len(html)
        if upto > at:
            stack[-1].parts.append(unescape(html[at:upto]))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break  # an inline end tag does not close a block
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            if not m[3].endswith("/"):
                at = end.end() if end else len(html)
            continue
        if tag in BLOCK and tag != "br":  # a block ends an open paragraph and what is open in it
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in ("html", "body"):
            if tag == "body" and not any(n.tag == "body" for n in stack):
                del stack[1:]
                node = Node("body", root)
                root.parts.append(node)
                stack.append(node)
            continue
        node = Node(tag, stack[-1], boilerplate(tag, m[3], stack))
        stack[-1].parts.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def in_order(root: Node) -> list[Node]:
    """The nodes not set aside, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(p for p in node.parts if type(p) is Node and not p.aside)
    return out


def measure(nodes: list[Node]) -> None:
    """Characters, tags and those of links, of every node with all below it."""
    for n in nodes:
        n.chars = n.link_chars = n.tags = n.link_tags = 0
    for n in reversed(nodes):
        n.chars += sum(len("".join(p.split())) for p in n.parts if type(p) is str)
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.tags + 1
        if n.parent is not None:
            up = n.parent
            up.chars += n.chars
            up.link_chars += n.link_chars
            up.tags += n.tags + 1
            up.link_tags += n.link_tags


def densities(nodes: list[Node], body: Node) -> None:
    """Composite text density and density sum of every node."""
    share = body.link_chars / max(1, body.chars)
    for n in nodes:
        n.total = 0.0
    for n in reversed(nodes):
        tags = max(1, n.tags)
        if not n.chars:
            n.density = 0.0
        else:
            plain = max(1, n.chars - n.link_chars)
            base = log(n.chars / plain * n.link_chars + share * n.chars + e)
            ratio = n.chars / max(1, n.link_chars) * tags / max(1, n.link_tags)
            n.density = n.chars / tags * log(max(ratio, 1.0)) / log(max(base, e))
        if n.parent is not None:
            n.parent.total += n.density
        if not any(type(p) is Node and not p.aside for p in n.parts):
            n.total = n.density


def select(root: Node) -> Node | None:
    """The subtree with the main text."""
    nodes = in_order(root)
    measure(nodes)
    # Menus without a telling name: blocks of several links and little else. In an
    # article such a block is text, such as a list of references.
    for n in nodes:
        n.within = n.tag in ("article", "main") or n.parent is not None and n.parent.within
        if n.tag in BLOCK and not n.within and n.tag not in ("html", "body", "article", "main") and n.link_tags >= LINK_COUNT and n.link_chars > LINK_SHARE * n.chars:
            n.aside = True
    nodes = in_order(root)
    measure(nodes)
    body = next((n for n in nodes if n.tag == "body"), root)
    if not body.chars:
        return None
    densities(nodes, body)
    blocks = [n for n in nodes if n.tag in BLOCK and n.chars]
    if not blocks:
        return body
    depth: dict[int, int] = {}
    for n in nodes:
        depth[id(n)] = depth[id(n.parent)] + 1 if n.parent is not None else 0

    def best(among: list[Node]) -> Node:
        return max(among, key=lambda n: (n.total, n.chars, depth[id(n)]))

    # Containers of text blocks compete; a lone paragraph stands for its container.
    holders = [n for n in blocks if n.tag not in HEADINGS and n.tag not in ("p", "br", "li", "td", "th", "dd", "dt")] or [body]
    top = best(holders)
    path, node = [], top
    while node is not None:
        path.append(node.density)
        if node is body:
            break
        node = node.parent
    threshold = min(path)
    return whole_article(best([n for n in holders if n.density >= threshold] or [top]), threshold, body)


def whole_article(node: Node, threshold: float, body: Node) -> Node:
    """The article that the densest subtree belongs to.

    That is the article or main element around it; without one, the subtree is
    widened to its parent as long as headings or blocks above the threshold stand
    beside it (the other sections of one text), but not from a mere division to
    the body.
    """
    for name in ("article", "main"):
        up = node
        while up is not None:
            if up.tag == name:
                return up
            up = up.parent
    while node is not body and node.parent is not None and (node.parent is not body or node.tag == "section"):
        beside = [p for p in node.parent.parts if type(p) is Node and p is not node and not p.aside and p.tag in BLOCK and p.chars]
        if not any(p.tag in HEADINGS or p.density >= threshold for p in beside):
            break
        node = node.parent
    return node


def text_of(node: Node | None) -> str:
    """The text below a node: white space in a block is one blank, blocks are joined by one."""
    if node is None:
        return ""
    out: list[str] = []
    todo: list = [(node, False)]
    while todo:
        part, heading_only = todo.pop()
        if type(part) is str:
            if not heading_only:
                out.append(part)
            continue
        if part is None:
            out.append(" ")
            continue
        if part.aside:
            continue
        only = heading_only and part.tag not in HEADINGS
        if part.tag == "header":  # a header inside the article gives its headings
            only = True
        inner = [(p, only) for p in reversed(part.parts)]
        if part.tag in BLOCK:
            todo.append((None, False))
            todo.extend(inner)
            todo.append((None, False))
        else:
            todo.extend(inner)
    return " ".join("".join(out).split())


def main_text(html: str | None) -> str:
    """Main text of a page; empty for NULL, empty and text-free pages."""
    return text_of(select(parse(html))) if html else ""


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, ``text``, ``n_chars``.

    * NULL html counts as an empty page; a page without main text has empty text.
    * Pages cut off anywhere and with missing end tags are read as far as they go.
    * NULL and repeated keys keep their rows; other columns may have any name; an
      empty table gives an empty result. A page is read by itself, whole, in
      memory of the order of its own size.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch["_html"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["_key"], batch["_url"], texts], ["_key", "_url", "text"])

    rows = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("_url"), F.col(f"`{html}`").alias("_html"))
    found = rows.mapInArrow(run, f"_key {kinds[0]}, _url {kinds[1]}, text string")
    return found.select(F.col("_key").alias(key), F.col("_url").alias(url), "text", F.length("text").cast("bigint").alias("n_chars"))
