"""Main-text extraction from web pages by composite text density.

Every node of a page's tree gets a density: its characters per tag, adjusted by how much of its text stands in links. A
node's density sum is the sum of its children's densities. The node with the largest sum marks the content; the least
density on its path to the body is the threshold that a subtree must reach to count as text of the page.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A quote opens only after an equals sign; one that never closes is a letter like others.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
# Elements by their part in HTML.
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset("head script style noscript template iframe nav header footer aside button select input textarea menu dialog svg canvas object embed audio video title".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("body table ul ol dl div article section main td th blockquote".split())
ROLES = frozenset("banner navigation contentinfo complementary search menu menubar toolbar dialog alertdialog".split())
# Class names that tell of a page's layout, not of the element's own part: has-sidebar, content-sidebar-wrap, side-by-side.
LAYOUT = re.compile(r"(?:^|[_-])(?:has|no|with|without|by)[_-]|(?:^|[_-])content[_-].*(?:wrap|wrapper|container|layout)$", re.I)
NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|popup|modal|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side(?=$|\s|[_-]?(?:nav|menu|col|column|rail|panel|widgets?|left|right)(?:$|[\s_-]))|footer|header|masthead|comments?|respond|disqus|share|social|related|newsletter|subscribe|login|pagination|pager)(?=$|[\s_-]|\d)", re.I)
CONTENT = frozenset("article main body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I) for tag in RAW}
LABEL = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Node:
    tag: str
    skip: bool = False
    named: bool = False  # as boilerplate, by class or id
    parts: list = field(default_factory=list)  # text and child nodes, in order
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def labels(attributes: str) -> tuple[bool, bool]:
    """(whether the role is one of boilerplate, whether a class or id says so)."""
    role = named = False
    for kind, a, b, c in LABEL.findall(attributes):
        tokens = (a or b or c).split()
        if kind.lower() == "role":
            role |= any(x.lower() in ROLES for x in tokens)
        else:
            named |= any(NAMED.search(x) and not LAYOUT.search(x) for x in tokens)
    return role, named


def skip_named(root: Node) -> None:
    """Skips the elements named as boilerplate, and forms, but for those that hold the content.

    These hold an article or main not named so itself, or half of the page's unlinked text and over four times that of
    such articles elsewhere; density decides on them.
    """
    found = nodes(root)
    if not any(x.named for x in found):
        return
    chars, told = {}, {}
    for node in reversed(found):
        inner = [x for x in node.parts if isinstance(x, Node) and not x.skip]
        own = sum(len("".join(x.split())) for x in node.parts if isinstance(x, str))
        n = chars[id(node)] = 0 if node.tag == "a" else own + sum(chars[id(x)] for x in inner)
        told[id(node)] = n if node.tag in ("article", "main") and not node.named else sum(told[id(x)] for x in inner)
    half, most = chars[id(root)] / 2, 4 * told[id(root)]
    for node in found:
        if node.named and node.tag not in CONTENT and not told[id(node)]:
            node.skip = chars[id(node)] < max(half, 1) or chars[id(node)] <= most


class Open:
    """The open elements, and by tag where they stand, so that each tag takes the same time however many are open."""

    def __init__(self, root: Node):
        self.stack, self.at, self.scopes = [root], {}, [0]

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append(node)

    def close(self, i: int) -> None:
        """Closes element i of the stack and what is open inside it."""
        while len(self.stack) > i:
            node = self.stack.pop()
            self.at[node.tag].pop()
            if node.tag in SCOPES:
                self.scopes.pop()

    def last(self, *tags: str) -> int:
        """Where the innermost of such elements stands, 0 if none is open."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close_inside(self, *tags: str) -> None:
        """Closes the innermost of such elements, unless a scope has opened inside it."""
        if (i := self.last(*tags)) and i >= self.scopes[-1]:
            self.close(i)


def parse(page: str) -> Node:
    """The tree of a page; tolerant of elements that aren't closed, or are closed twice. The time is in proportion to the page."""
    root = Node("html")
    opened, at, n = Open(root), 0, len(page)

    def text(piece: str) -> None:
        if piece:
            opened.stack[-1].parts.append(entities.unescape(piece) if "&" in piece else piece)

    while at < n and (m := TAG.search(page, at)):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if i := opened.last(tag):
                opened.close(i)
            continue
        if tag in ("html", "body") and (tag == "html" or opened.last(tag)):
            continue
        if tag in ENDS_P:
            opened.close_inside("p")
        if tag in CLOSED_BY:
            opened.close_inside(*CLOSED_BY[tag])
        told = bool(opened.last("article", "main"))
        role, named = labels(m[3]) if m[3] else (False, False)
        skip = tag in BOILERPLATE or role and tag not in CONTENT
        if tag == "header" and told:
            skip = role
        node = Node(tag, skip, named and not (told and tag in HEADINGS) or tag == "form")
        opened.stack[-1].parts.append(node)
        if tag in RAW:
            end = END_OF[tag].search(page, at)
            if tag == "xmp":
                node.parts.append(page[at : end.start()])
            at = end.end()
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            opened.push(node)
    text(page[at:])
    skip_named(root)
    return root


def nodes(root: Node) -> list[Node]:
    """All nodes outside boilerplate, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in node.parts if isinstance(x, Node) and not x.skip]
    return out


def measure(root: Node) -> list[Node]:
    """Fills in the counts, densities and density sums of all nodes."""
    found = nodes(root)
    for node in reversed(found):
        for x in node.parts:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            elif not x.skip:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in found:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e
            node.density = c / t * max(math.log(c / lc * t / lt), 0.0) / math.log(base)
    for node in found:
        node.total = sum(x.density for x in node.parts if isinstance(x, Node) and not x.skip)
    return found


def content(root: Node) -> list[Node]:
    """The subtrees that hold the page's main text, in page order: in the page's article, if it tells one, or in the whole page."""
    measured = measure(root)
    if told := article(root, measured):
        inner = nodes(told)
        titles = [] if any(x.tag == "h1" for x in inner) else _before(root, told)
        return titles + dense(told, inner)
    return dense(root, measured)


def article(root: Node, found: list[Node]) -> Node | None:
    """The one outermost article or main that isn't named as boilerplate, if it holds a twelfth of the page's unlinked text.

    Readers' comments, teasers and notes beside it are then no part of the text, whatever their classes are and however
    dense they are. Several such elements side by side tell nothing: they may be an index or the comments themselves.
    """
    outer, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main") and not node.named:
            outer.append(node)
        else:
            todo += [x for x in node.parts if isinstance(x, Node) and not x.skip]
    own = [x for x in outer if x.chars > x.link_chars]
    if len(own) != 1:
        return None
    return own[0] if 12 * (own[0].chars - own[0].link_chars) >= root.chars - root.link_chars else None


def _before(root: Node, end: Node) -> list[Node]:
    """The h1 in front of a node, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node is end:
            break
        if node.tag == "h1":
            out += [node] if node.chars > node.link_chars else []
        else:
            todo += reversed([x for x in node.parts if isinstance(x, Node) and not x.skip])
    return out


def dense(root: Node, found: list[Node]) -> list[Node]:
    """The subtrees under root that reach the least density on the way from the node of the largest density sum, in page order."""
    parent = {id(x): node for node in found for x in node.parts if isinstance(x, Node) and not x.skip}
    best = max(found, key=lambda x: x.total)
    if not best.total:
        return [root] if root.chars else []
    threshold, up = best.density, best
    while (up := parent.get(id(up))) is not None and up.tag != "html":
        threshold = min(threshold, up.density)

    def largest(node: Node) -> Node:
        """The node of the largest density sum in a subtree."""
        return max(nodes(node), key=lambda x: x.total)

    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag not in ("html", "body") and node.density >= threshold and node.tag not in INLINE:
            top = largest(node)
            out.append(node if top.total == 0 or top is best or top.tag in INLINE else top)
        else:
            todo += reversed([x for x in node.parts if isinstance(x, Node) and not x.skip])
    return [best] if best.tag in ("html", "body") else out or [best]


def blocks(node: Node) -> list[str]:
    """The texts of a subtree's blocks, white space made single."""
    out, line = [], []

    def close() -> None:
        if joined := " ".join("".join(line).split()):
            out.append(joined)
        line.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            line.append(x)
        elif x.skip:
            continue
        elif x.tag in ("br", "img", "wbr"):
            line.append(" " if x.tag == "br" else "")
        elif x.tag in INLINE:
            todo += reversed(x.parts)
        else:
            close()
            todo.append(None)
            todo += reversed(x.parts)
    close()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(b for node in content(parse(page)) for b in blocks(node)) if page else ""


def extracted_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of pages(page_id, url, html).

    Null or empty html, and pages without text, give an empty text. Markup that isn't closed, or is cut off, is read as
    far as it goes. Nothing is capped; repeated rows stay; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(h) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
