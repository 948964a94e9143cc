"""Main text of HTML pages by composite text density.

A page becomes a tree of elements (implied end tags closed, scripts and
comments never entered).  Elements without prose (scripts, buttons, fields)
and hidden ones are cut.  An element named boilerplate (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments) goes if most of
its text is links.  If its tag or role says so, or all of one of its names is
such words and words of plain structure (``site-footer``, ``ad-slot-top``,
``comment-list``), it goes with all its text, unless next to nothing is left
outside such elements (under 1/``HOLDS`` of it: a form or header around the
whole page; never for reader comments): then it is like any other, and what is
in it is judged with its own text outside named elements as the rest.  Another
name with some such words (``share-enabled``) halves the density.
What holds the article stays.  Every element gets its characters per tag,
adjusted for the characters in links (composite text density).  The density
sum of an element is the sum of its children's densities; the subtree of the
largest sum is the main one.  The least density on the path from it up to the
body is the threshold: side branches of the path that reach it belong to the
text as well, articles like all others.  Text directly in an element of the
path, with the inline elements in it, is such a branch of one tag.

Pages are parsed one by one inside tasks; the work is linear in the page.

Defined results: a null or empty page has no text; a page without elements is
one block; a page cut off inside a tag or comment loses that tag or comment;
repeated rows give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split())
CUT_TAGS = frozenset(
    "button canvas datalist head iframe input label noscript object option script select style svg template textarea "
    "title".split())
NAMED_TAGS = frozenset("aside dialog footer form header menu nav".split())
CUT_WORDS = frozenset(
    "ad ads adbox advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices outbrain pager pagination popup promo promoted promotion related replies respond search share sharing "
    "sidebar sidebars signup social sponsor sponsored subscribe taboola toolbar widget widgets".split())
# words of names that say nothing of the content
PLAIN_WORDS = frozenset(
    "area bar bars block blocks body bottom box boxes button buttons center col column container foot form global group "
    "holder inner item items left link links list lists main message outer page panel primary right row section secondary "
    "site slot slots thread threads top unit units wrap wrapper zone".split())
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
HOLDS = 20
CUT_ROLES = frozenset("banner complementary contentinfo dialog form menu menubar navigation search".split())
KEEP_TAGS = frozenset(("html", "body", "main", "article"))
# an open element of the first kind ends where one of the second starts, within the elements of the third
ENDS = {
    "p": (frozenset("address article aside blockquote details dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split()),
          frozenset("button td th table object".split())),
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "tbody", "tfoot", "thead")), frozenset(("table",))),
    "td": (frozenset(("td", "th", "tr", "tbody", "tfoot")), frozenset(("table",))),
    "th": (frozenset(("td", "th", "tr", "tbody", "tfoot")), frozenset(("table",))),
    "option": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
    "head": (frozenset(("body",)), frozenset()),
}
_ENDED_BY: dict[str, list[str]] = {}
for _open, (_starts, _) in ENDS.items():
    for _x in _starts:
        _ENDED_BY.setdefault(_x, []).append(_open)

# quotes count only after "="; possessive, so the scan is linear
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element: children are elements and strings, in order."""

    __slots__ = ("tag", "parent", "children", "cut", "named", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, named: int = 0):
        self.tag, self.parent, self.children, self.cut, self.named = tag, parent, [], cut, named
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def boilerplate(tag: str, attributes: str) -> tuple[bool, int]:
    """Whether an element is cut whatever its text, and how it is named: 2 if the tag, the role or all words of a class or
    an id stand for boilerplate (3: reader comments), 1 if some words of a class or id do, else 0."""
    if tag in CUT_TAGS:
        return True, 0
    hidden, named = False, 2 if tag in NAMED_TAGS else 0
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "role":
            named = max(named, 2 * (value.lower() in CUT_ROLES))
        elif name in ("class", "id"):
            for x in value.split():
                found = _WORD.findall(_CAMEL.sub(" ", x).lower())
                if any(w in CUT_WORDS for w in found):
                    whole = all(w in CUT_WORDS or w in PLAIN_WORDS for w in found)
                    named = max(named, 1 + whole + (whole and any(w in COMMENT_WORDS for w in found)))
        elif name == "hidden":
            hidden |= not value.lower().startswith("until")
        elif name == "style":
            hidden |= bool(_NO_DISPLAY.search(unescape(value)))
    if tag in KEEP_TAGS:  # a page or an article is no boilerplate, but a comment may be marked up as an article
        return False, named if tag == "article" and named == 3 else 0
    return hidden, named


def parse(html: str) -> tuple[Node, list[Node]]:
    """The root element and all elements, parents before children."""
    root = Node("html", None)
    top, nodes, at, n = root, [root], 0, len(html)
    open_tags = {"html": 1}
    body = None

    def close(node: Node) -> Node:
        """Closes the open elements down to ``node``; the parent stays open."""
        nonlocal top
        while True:
            open_tags[top.tag] -= 1
            last, top = top, top.parent
            if last is node:
                return top

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            top.children.append(html[at:])
            break
        if m.start() > at:
            top.children.append(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[4] != ">":  # cut off inside a tag
            break
        if m[1]:
            if tag in ("html", "body"):
                continue
            if open_tags.get(tag):
                x = top
                while x.tag != tag:
                    x = x.parent
                if x.parent is not None:
                    close(x)
            elif tag == "p":
                top.children.append(Node("p", top))
                nodes.append(top.children[-1])
            continue
        if tag == "html" or tag == "body" and body is not None:
            continue
        for ended in _ENDED_BY.get(tag, ()):
            if open_tags.get(ended):
                x, within = top, ENDS[ended][1]
                while x.tag != ended and x.tag not in within and x.parent is not None:
                    x = x.parent
                if x.tag == ended:
                    close(x)
        attributes = m[3]
        node = Node(tag, top, *boilerplate(tag, attributes))
        top.children.append(node)
        nodes.append(node)
        if tag == "body":
            body = node
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            if end is None:
                at = n
            else:
                at = html.find(">", end.end() - 1)
                at = n if at < 0 else at + 1
            continue
        open_tags[tag] = open_tags.get(tag, 0) + 1
        top = node
    return root, nodes


def _count(nodes: list[Node]) -> None:
    """Characters, tags and link characters below each element."""
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        link = node.tag == "a"
        for x in node.children:
            if isinstance(x, str):
                size = len("".join(unescape(x).split()))
                node.chars += size
                node.link_chars += size * link
            elif not x.cut:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.chars if link else x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Composite density; ``share`` is that of link characters on the page."""
    if not chars:
        return 0.0
    base = math.log(chars * link_chars / max(1, chars - link_chars) + share * chars + math.e)
    inner = max(math.e, chars / max(1, link_chars) * max(1, tags) / max(1, link_tags))
    return chars / max(1, tags) * math.log(inner) / math.log(base) if base > 1.01 else 0.0


def _measure(nodes: list[Node], body: Node) -> float:
    """Composite density and density sum of each element, and the share of link characters."""
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        if node.named:
            node.density /= 2  # a name with some words of boilerplate
        if node.parent is not None:
            node.parent.sum += node.density
    return share


def _live(nodes: list[Node]) -> list[Node]:
    """The elements that are not cut nor below a cut one."""
    live = []
    for node in nodes:  # parents come first
        if node.parent is not None and node.parent.cut:
            node.cut = True
        if not node.cut:
            live.append(node)
    return live


def _cut_named(live: list[Node]) -> list[Node]:
    """The elements that stay once boilerplate by name is cut; parents are judged before what is in them."""
    if not any(x.named for x in live):
        return live
    plain = lambda x: x.chars - x.link_chars
    # text outside links in each wholly named element (or the page) and outside such elements in it
    own, holder = {id(live[0]): plain(live[0])}, {}
    for x in live:
        up = id(live[0]) if x.parent is None else holder[id(x.parent)]
        if x.named >= 2 and x is not live[0]:
            own[up] -= plain(x)
            own[id(x)] = plain(x)
            up = id(x)
        holder[id(x)] = up
    rest = own[id(live[0])]
    for x in live:
        if x.parent is not None and x.parent.cut:
            x.cut = True
        elif x.named:
            x.cut = 2 * x.link_chars > x.chars or x.named == 3 and rest > 0 or x.named == 2 and HOLDS * rest >= max(1, plain(x))
            if x.named >= 2 and not x.cut:
                x.named, rest = 0, rest + own[id(x)]
    live = _live(live)
    _count(live)
    return live


def _texts(node: Node, out: list[str]) -> None:
    """Text of the subtree in page order; NUL marks the edges of blocks."""
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.cut:
            if x.tag in BLOCK:
                out.append("\0")
                stack.append("\0")
            stack.extend(reversed(x.children))


def _dense(branches: list, limit: float, share: float) -> list[str]:
    """Text of the side branches that reach the threshold; strings and inline elements side by side are one branch, and
    such an element is another by itself."""
    out: list[str] = []
    inline = lambda x: isinstance(x, str) or x.tag not in BLOCK
    for together, group in groupby(branches, inline):
        run = [x for x in group if isinstance(x, str) or not x.cut]
        if together:
            found = Node("", None)
            found.children = run
            _count([found])
            if _density(found.chars, found.tags, found.link_chars, found.link_tags, share) >= limit > 0:
                for x in run:
                    _texts(x, out)
                continue
        for x in run:
            if not isinstance(x, str) and x.density >= limit > 0:
                _texts(x, out)
    return out


def _hold_article(nodes: list[Node]) -> None:
    """An element around the article is not boilerplate, and a header within it is part of it; articles in reader comments
    are comments."""
    for node in nodes:
        if node.tag in ("article", "main") and node.named < 3:
            above, x = [], node.parent
            while x is not None and x.named < 3:
                above.append(x)
                x = x.parent
            if x is None:
                for x in above:
                    x.cut, x.named = False, 0
    for node in nodes:
        if node.named and node.tag == "header":
            x = node.parent
            while x is not None and x.tag != "article":
                x = x.parent
            node.named = node.named if x is None else 0


def main_text(html: str | None) -> str:
    """The main text of a page: blocks in page order, white space as one space."""
    if not html:
        return ""
    root, nodes = parse(html.replace("\0", " "))
    _hold_article(nodes)
    live = _live(nodes)
    _count(live)
    live = _cut_named(live)
    body = next((x for x in live if x.tag == "body"), root)
    share = _measure(live, body)
    inner = [x for x in live if x is not root and x.tag != "head"]
    best = max(inner, key=lambda x: x.sum, default=body)
    if best.sum <= 0:
        best = body
    path, x = [], best
    while x is not None:
        path.append(x)
        x = x.parent
    limit = min((x.density for x in path if x is not root and x.density > 0), default=0.0)
    out: list[str] = []
    ends: list[list[str]] = []
    for x, below in zip(reversed(path), path[-2::-1]):
        at = x.children.index(below)
        edge = ["\0"] if below.tag in BLOCK else []
        out += _dense(x.children[:at], limit, share) + edge
        ends.append(edge + _dense(x.children[at + 1:], limit, share))
    _texts(best, out)
    for x in reversed(ends):
        out += x
    blocks = (" ".join(unescape(b).split()) for b in "".join(out).split("\0"))
    return " ".join(b for b in blocks if b)


def extract(pages: DataFrame, html: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the main text in column ``to`` in place of the html (and of a column of that name); no shuffle."""
    rest = [c for c in pages.columns if c != html and c.lower() != to.lower()]
    fields = pages.select(*[F.col(f"`{c}`") for c in rest]).schema.fields
    schema = T.StructType([*fields, T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(a, 500) for x in batches for a in range(0, x.num_rows, 500)):
            texts = [main_text(h) for h in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=schema.names)

    return pages.mapInArrow(run, schema)
