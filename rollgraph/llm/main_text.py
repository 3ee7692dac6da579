"""Main text of web pages by composite text density (operator 2).

Every DOM node gets its characters per tag, adjusted by its links: ``C/T *
log_b(C*T / (LC*LT))`` with base ``ln(C*LC/NC + LCb*C/Cb + e)``, where C and T are
characters and tags of the node, LC and LT those of its links, NC the other characters
and b the body.  A node's density sum is the sum over its child blocks.  The block with
the largest sum is the centre of the text; the least density on its path to the body is
the threshold, and every block above it adds its subtree with the largest sum.  What
lies between two chosen siblings, headings right before one and text blocks beside one
belong to the text, too, unless links make up half of them.

Elements whose very tag or role says that they are no text (scripts, forms, menus,
footers) have no density.  Words of a class or id that name page parts (adverts, notices,
comments) only divide the density of a block and of what it holds by ``PENALTY``; where
nine tenths of the text without links are in such blocks, not that of one with half.  Such a block is left out of a
chosen subtree if it falls below the threshold.  Blocks are separated by block elements;
white space inside one becomes a single space.

Cases: null, empty and text-less pages give an empty text; unclosed and misnested tags
are repaired; repeated rows are extracted each, so ties between blocks go to the one
that comes first; a null url or page_id is carried along; pages of any length and depth
are read whole, without recursion; an empty table gives no rows; columns other than
page_id, url and html are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML element names, and words that name page parts beside the text.
PENALTY = 20.0
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
BESIDE = HEADINGS | {"p", "ul", "ol", "dl", "blockquote", "pre", "table", "figure", "section"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HIDDEN = {
    "aside", "audio", "button", "canvas", "dialog", "embed", "footer", "form", "head", "iframe", "input", "label",
    "math", "menu", "nav", "noscript", "object", "script", "select", "style", "svg", "template", "textarea", "title",
    "video",
}
CLOSES_SELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ASIDE = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "aside", "banner", "breadcrumb", "breadcrumbs",
    "comment", "commentlist", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo",
    "promotion", "recommended", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
ROLES = {
    "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation",
    "search", "toolbar",
}


class _Node:
    __slots__ = ("tag", "parent", "parts", "aside", "named", "chars", "tags", "link_chars", "link_tags", "density", "total", "order")

    def __init__(self, tag: str, parent: _Node | None, aside: bool, named: bool, order: int):
        self.tag, self.parent, self.aside, self.named, self.order = tag, parent, aside, named, order
        self.parts: list[_Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def blocks(self) -> list[_Node]:
        """Child blocks with text that count."""
        return [p for p in self.parts if isinstance(p, _Node) and not p.aside and p.chars and p.tag in BLOCKS]


def _hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an element's tag, role or style says that it is no text."""
    if tag in HIDDEN:
        return True
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value in ROLES:
            return True
    return False


def _named_beside(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether words of the class or id name a part beside the text."""
    words = " ".join(value or "" for name, value in attrs if name in ("class", "id")).lower()
    return bool(words) and not ASIDE.isdisjoint(re.split(r"[^a-z]+", words))


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("html", None, False, False, 0)
        self.nodes = [self.root]
        self.stack = [self.root]
        self.body: _Node | None = None

    def _close_to(self, k: int) -> None:
        del self.stack[k:]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "html":
            return
        if tag in BLOCKS and tag not in ("html", "body"):  # a block ends an open paragraph
            for k in range(len(self.stack) - 1, 0, -1):
                held = self.stack[k].tag
                if held == "p":
                    self._close_to(k)
                    break
                if held in BLOCKS:
                    break
        if tag in CLOSES_SELF:
            same = {"td", "th"} if tag in ("td", "th") else {"dt", "dd"} if tag in ("dt", "dd") else {tag}
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in same:
                    self._close_to(k)
                    break
                if self.stack[k].tag in CLOSES_SELF[tag]:
                    break
        if tag == "body":
            self._close_to(1)  # the head ends here at the latest
            if self.body is not None:
                return
        above = self.stack[-1]
        # A header at the top is the site's, one further down that of its text.
        aside = _hidden(tag, attrs) or (tag == "header" and above.tag in ("html", "body"))
        node = _Node(tag, above, aside, _named_beside(attrs), len(self.nodes))
        self.nodes.append(node)
        above.parts.append(node)
        if tag == "body":
            self.body = node
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag and tag in ("script", "style"):
            self.stack.pop()

    def handle_endtag(self, tag: str) -> None:
        inline = tag not in BLOCKS
        for k in range(len(self.stack) - 1, 0, -1):
            held = self.stack[k].tag
            if held == tag:
                self._close_to(k)
                return
            if inline and held in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].parts.append(data)


def _measure(nodes: list[_Node], body: _Node) -> None:
    """Counts, densities and density sums, children before parents."""
    for node in reversed(nodes):
        if node.aside:
            continue
        for part in node.parts:
            if isinstance(part, str):
                node.chars += sum(map(len, part.split()))
            elif not part.aside:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags + (part.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / max(body.chars, 1)
    # Names tell nothing on a page whose text is nearly all in named blocks; the largest is not penalised then.
    below, named_chars = set(), 0  # nodes inside a hidden or named one
    for node in nodes:
        if node.parent and (node.parent.order in below or node.parent.aside or node.parent.named):
            below.add(node.order)
        elif node.named and not node.aside:
            named_chars += node.chars - node.link_chars
    plain = body.chars - body.link_chars
    telling = 10 * named_chars <= 9 * plain
    for node in nodes:  # what a penalised block holds is penalised with it
        held = telling or 2 * (node.chars - node.link_chars) < plain
        node.named = held and (node.named or bool(node.parent and node.parent.named))
    for node in reversed(nodes):
        if node.aside or not node.chars:
            continue
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
        node.density = max(0.0, c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9) / math.log(max(base, 1.0) + 1e-9)) if base > 1.0001 else c / t
        if node.named:
            node.density /= PENALTY
        node.total = sum(p.density for p in node.blocks()) or node.density * 0.5


def _largest(nodes: list[_Node]) -> dict[int, _Node]:
    """The block with the largest density sum below (or at) each block; of equal ones
    the first."""
    best: dict[int, _Node] = {}
    for node in reversed(nodes):
        if node.aside or not node.chars:
            continue
        top = node if node.tag in BLOCKS or node.parent is None else None
        for part in node.parts:
            found = best.get(part.order) if isinstance(part, _Node) else None
            if found is not None and (top is None or found.total > top.total):
                top = found
        if top is not None:
            best[node.order] = top
    return best


def _beside(node: _Node) -> bool:
    """Whether a block next to a chosen one is text of the same kind."""
    return node.tag in BESIDE and not node.aside and not node.named and 2 * node.link_chars < max(node.chars, 1)


def _chosen(parent: _Node, marked: set[int], top: bool) -> list[_Node | str]:
    """The children that belong to the text, given the marked ones among them."""
    parts = parent.parts
    at = [i for i, p in enumerate(parts) if isinstance(p, _Node) and p.order in marked]
    first, last = at[0], at[-1]
    heads = first
    while heads and (isinstance(parts[heads - 1], str) and not parts[heads - 1].strip() or isinstance(parts[heads - 1], _Node) and parts[heads - 1].tag in HEADINGS | {"header"} and _inside(parts[heads - 1])):
        heads -= 1
    out: list[_Node | str] = []
    for i, part in enumerate(parts):
        if isinstance(part, str):
            if first < i < last:
                out.append(part)
        elif part.order in marked or heads <= i < first or first < i < last and _inside(part) or not top and _beside(part):
            out.append(part)
    return out


def _inside(node: _Node) -> bool:
    """Whether a part among chosen ones is text and not a box of links or a named part."""
    return not node.aside and not node.named and (2 * node.link_chars < max(node.chars, 1) or node.tag not in BLOCKS)


def _regions(tree: _Tree) -> tuple[list[_Node | str], float]:
    """Chosen parts in page order, and the threshold."""
    body = tree.body or tree.root
    _measure(tree.nodes, body)
    best = _largest(tree.nodes)
    if body.order not in best or not body.chars:
        return [], 0.0
    centre = best[body.order]
    path, node = [], centre
    while node is not None and node is not body.parent:
        path.append(node)
        node = node.parent
    threshold = min((n.density for n in path if n.chars and n.tag in BLOCKS), default=0.0)
    marked, stack = set(), [body]
    while stack:
        node = stack.pop()
        if node.density >= threshold - 1e-9 and node.chars and (node.tag in BLOCKS or node is body):
            marked.add(best[node.order].order)
        stack += [p for p in node.parts if isinstance(p, _Node) and not p.aside]
    if body.order in marked:
        return [body], threshold
    out, stack = [], [body]
    while stack:  # outermost marked nodes, in page order
        node = stack.pop()
        if isinstance(node, str) or node.order in marked:
            out.append(node)
        elif any(isinstance(p, _Node) and p.order in marked for p in node.parts):
            own = _chosen(node, marked, node is body)
            kept = {id(p) for p in own}
            for part in reversed(node.parts):  # the others may hold marked blocks further down
                if id(part) in kept:
                    if isinstance(part, _Node):
                        marked.add(part.order)
                    stack.append(part)
                elif isinstance(part, _Node) and not part.aside:
                    stack.append(part)
        else:
            stack += [p for p in reversed(node.parts) if isinstance(p, _Node) and not p.aside]
    return out, threshold


def _blocks(regions: list[_Node | str], threshold: float) -> list[str]:
    """Texts of the blocks of the chosen parts, white space made single."""
    out, held = [], []

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    stack: list = list(reversed(regions))
    while stack:
        part = stack.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            held.append(part)
        elif part.aside or (part.named and part.density < threshold):
            continue
        elif part.tag == "br":
            held.append(" ")
        elif part.tag in BLOCKS:
            flush()
            stack.append(None)
            stack += reversed(part.parts)
        else:
            stack += reversed(part.parts)
    flush()
    return out


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return "\n\n".join(_blocks(*_regions(tree)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every (page_id, url, html) row."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
