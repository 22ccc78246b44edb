"""Main text of HTML pages by tree scoring.

The page is read into a tree by a tokenizer that closes what HTML closes by
itself (paragraphs, list items, cells, ...).  Paragraphs earn points for
length and commas; they pass them to their ancestors, with less for each
level.  A container's points are discounted by the share of its text that is
inside links, and moved by the words of its class and id.  The container with
the most points is kept, with the siblings that score well too, are long
paragraphs with few links, or are headings, lists, tables, figures and short
sections of its own level without links; from there up, headlines and what
scores well are kept beside the way to the top.  Menus, headers and footers of
the page, sidebars, notices, adverts, forms, scripts, styles and reader comments
are left out wherever they stand.  Names are read in parts (``sideBar``,
``side-bar``, ``adsbox``); names that an article's own parts may have as well
count outside of it only.

The text of the kept blocks is taken whole: character references are decoded,
white space inside a block becomes one space, blocks are joined in page order
by one newline.

Defined results: null and empty pages, and pages without text, give an empty
text.  Broken markup is read as far as it goes: what follows an unclosed
comment or script belongs to it, a tag that never ends is text, and where more
than ``QUOTES`` tags hold quotes that never end, quotes no longer hide the ends of
tags (so the time grows with the page's length).  Text that stands in no element
is a paragraph of the page.  Each row is handled by itself; repeated rows get
repeated results and an empty table an empty one.  Of containers with equal points
the first is kept.  Pages of any length are read whole.  Other columns are kept,
whatever their names, but for ``text`` and ``n_chars``, which are replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeledger.llm.util import unused

# Names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
DROPPED = frozenset("head nav footer aside form button select option input label script style noscript template "
                    "iframe object embed svg canvas math audio video map dialog menu title textarea link meta".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
#: Opening one of these closes an open paragraph.
ENDS_P = BLOCKS - frozenset("caption body html legend summary tbody td tfoot th thead tr".split())
#: Opening an element closes these, up to the element that bounds the search.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
            "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
#: Words of a class, id or role that mark what is no part of an article.
BAD = frozenset("ad ads advert advertisement advertising adv banner breadcrumb breadcrumbs comment comments "
                "commentlist contact cookie cookies consent disqus footer footnav gdpr hidden masthead menu menubar "
                "modal nav navbar navigation newsletter notice notification outbrain pager pagination popup promo "
                "promoted related remark replies reply respond rss share sharing sidebar sidebars skip social sponsor "
                "sponsored subscribe subscription taboola toolbar topbar widget widgets alert search login signup "
                "complementary contentinfo response responses".split())
#: Of these, names that parts of an article may have too.
WEAK = frozenset("remark search contact login signup alert respond response responses page related reply".split())
#: Words that begin or end a longer name with the same meaning.
STEMS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor", "subscri")
_PARTS = re.compile(r"(ads?|comments?|cookies?|menu|nav|promos?|shar(?:e|ing)|side|social)"
                    r"(area|bar|block|box|container|list|panel|section|slot|unit|widget|wrap|wrapper|zone)s?")
GOOD = frozenset("article articlebody body content entry main post story text blog hentry page".split())

#: Tags whose quotes never end, after which quotes are plain characters.
QUOTES = 16
_NAMED = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                   re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_COMMAS = re.compile(r"[,،、，]")


_RAW_ENDS = {name: re.compile(r"</%s(?=[\s/>])[^>]*>?" % name, re.I) for name in RAW}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("name", "marks", "parent", "children", "score", "size", "linked")

    def __init__(self, name: str, marks: frozenset, parent: "Node | None"):
        self.name, self.marks, self.parent = name, marks, parent
        self.children: list[Node | str] = []
        self.score, self.size, self.linked = 0.0, 0, 0


def _marks(attrs: str) -> frozenset:
    if "=" not in attrs and "hidden" not in attrs.lower():
        return frozenset()
    out = set()
    for m in _ATTR.finditer(attrs):
        key, plain = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        value = plain.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.add("hidden")
        elif key in ("class", "id", "role"):
            for name in plain.split():
                out.update(_names(name))
    return frozenset(out)


def _names(name: str) -> set[str]:
    """The words of one class or id, and what two of them make together."""
    parts = [x.lower() for x in _NAME.findall(name)]
    out = {*parts, *(a + b for a, b in zip(parts, parts[1:]))}
    for word in list(out):
        out.update(stem for stem in STEMS if word.startswith(stem) or word.endswith(stem))
        if m := _PARTS.fullmatch(word):
            out.add({"side": "sidebar", "sharing": "share"}.get(m.group(1), m.group(1)))
    if "subscri" in out:
        out.add("subscribe")
    return out


class _Tags:
    """Finds a page's tags and comments from left to right."""

    def __init__(self, page: str):
        self.page, self.bad = page, 0

    def _end(self, at: int) -> int:
        """Where a tag whose attributes begin at ``at`` ends: behind the first
        ``>`` outside quotes, else behind the first at all."""
        page, i = self.page, at
        while self.bad <= QUOTES:
            m = _STOP.search(page, i)
            if m is None:
                self.bad += 1
                break
            if m.group() == ">":
                return m.end()
            close = page.find(m.group(), m.end())
            i = m.end() if close < 0 else close + 1
        return page.find(">", at) + 1

    def next(self, at: int):
        """(start, end, closes, name, attributes) of the next tag, with name
        None for comments and the like; None if there is no more."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0 or start + 1 >= len(page):
                return None
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, False, None, ""
            m = _NAMED.match(page, start + 1)
            if m is None:
                if page[start + 1] in "!?/":
                    end = page.find(">", start)
                    return start, len(page) if end < 0 else end + 1, False, None, ""
                at = start + 1
                continue
            if page.find(">", m.end()) < 0:
                return None
            end = self._end(m.end())
            return start, end, bool(m.group(1)), m.group(2).lower(), page[m.end():end - 1]


def parse(page: str) -> Node:
    """The tree of a page; children are nodes and pieces of raw text."""
    root = Node("#root", frozenset(), None)
    at, here, tags = 0, root, _Tags(page)
    open_ = Counter()  # of the elements from here up

    def up(to: Node) -> None:
        nonlocal here
        while here is not to:
            open_[here.name] -= 1
            here = here.parent

    while (tag := tags.next(at)) is not None:
        start, end, closes, name, attrs = tag
        if start > at:
            here.children.append(page[at:start])
        at = end
        if name is None:
            continue
        if closes:
            if not open_[name]:
                continue
            node = here
            while node.name != name:
                # An end tag inside a block does not close what is around it.
                if name not in BLOCKS and node.name in BLOCKS:
                    break
                node = node.parent
            if node.name == name:
                up(node.parent)
            continue
        if name in ENDS_P and open_["p"]:
            node = here
            while node is not root and node.name != "p" and node.name not in ENDS_P and node.name not in ("td", "th"):
                node = node.parent
            if node.name == "p":
                up(node.parent)
        if name in SIBLINGS:
            ends, bounds = SIBLINGS[name]
            if any(open_[x] for x in ends):
                node = here
                while node is not root and node.name not in bounds and node.name not in ends:
                    node = node.parent
                while node.name in ends and node.parent.name in ends:
                    node = node.parent
                if node.name in ends:
                    up(node.parent)
        node = Node(name, _marks(attrs), here)
        here.children.append(node)
        if name in RAW:
            m = _RAW_ENDS[name].search(page, at)
            stop = m.start() if m else len(page)
            if name == "textarea" or name == "title":
                node.children.append(page[at:stop])
            at = m.end() if m else len(page)
        elif name not in VOID:
            here = node
            open_[name] += 1
    if at < len(page):
        here.children.append(page[at:])
    return root


def dropped(node: Node, in_article: bool) -> bool:
    """Whether a node is no part of any article."""
    if node.name in DROPPED or "hidden" in node.marks:
        return True
    if node.name == "header" and not in_article:
        return True
    if node.name in ("article", "main", "body", "html") and not node.marks & {"comment", "comments", "ad", "ads"}:
        return False
    bad = node.marks & BAD
    if in_article and bad <= WEAK:
        return False
    return bool(bad) and not (node.marks & GOOD and not node.marks & {
        "comment", "comments", "sidebar", "footer", "related", "ad", "ads", "nav", "menu"})


def _measure(root: Node) -> list[Node]:
    """Sets size and linked of all nodes, in letters; the nodes in order.
    What is dropped is cut out of the tree."""
    order, stack = [], [(root, False, False)]
    while stack:
        node, in_article, in_link = stack.pop()
        order.append(node)
        inside = in_article or node.name in ("article", "main")
        kept = []
        for c in node.children:
            if isinstance(c, str):
                n = len(c) - c.count(" ") if not c.isspace() else 0
                node.size += n
                node.linked += n if in_link or node.name == "a" else 0
                kept.append(c)
            elif not dropped(c, inside):
                kept.append(c)
        node.children = kept
        stack.extend((c, inside, in_link or node.name == "a") for c in reversed(kept) if not isinstance(c, str))
    for node in reversed(order):
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.linked += node.linked
    return order


def _own_text(node: Node) -> str:
    """Text of a paragraph without the blocks inside it."""
    out, stack = [], [iter(node.children)]
    while stack:
        c = next(stack[-1], None)
        if c is None:
            stack.pop()
        elif isinstance(c, str):
            out.append(c)
        elif c.name not in BLOCKS:
            stack.append(iter(c.children))
    return "".join(out)


def density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def score(order: list[Node]) -> None:
    """Points of paragraphs, passed on to ancestors."""
    for node in order:
        if node.name in PARAGRAPHS or (node.name in ("div", "section", "article", "main", "body", "#root") and any(
                isinstance(c, str) and not c.isspace() for c in node.children)):
            text = _own_text(node)
            n = len(text.strip())
            if n < 25:
                continue
            points = (1 + len(_COMMAS.findall(text)) + min(n / 100, 3)) * (1 - density(node))
            holder = node.parent if node.name in PARAGRAPHS else node
            level = 0
            while holder is not None and level < 6:
                holder.score += points / (1, 2, 3, 6, 9, 12)[level]
                holder, level = holder.parent, level + 1
    for node in order:
        if node.score:
            node.score *= 1 - density(node)
            if node.name in ("article", "main"):
                node.score = node.score * 1.5 + 10
            elif node.marks & GOOD:
                node.score *= 1.25


def _holds(node: Node, names: frozenset) -> bool:
    stack = [node]
    while stack:
        n = stack.pop()
        if n.name in names:
            return True
        stack.extend(c for c in n.children if not isinstance(c, str))
    return False


def _sentence(node: Node) -> bool:
    return any(c in _own_text(node) for c in ".!?:;。！？")


def _belongs(c: Node, best: Node, close: bool) -> bool:
    """Whether a sibling of the best container (``close``), or of an element
    that holds it, is part of the article."""
    if not c.size or c.name == "a":
        return False
    same = 0.2 * best.score if c.marks and c.marks == best.marks else 0.0
    if c.score + same >= max(10.0, best.score * 0.2):
        return True
    links = density(c)
    if c.name in HEADINGS:
        return links < 0.5
    if not close:  # further up, headlines in a wrapper of their own
        return c.name in ("div", "hgroup", "section") and links < 0.3 and c.size < 300 and _holds(c, frozenset(("h1",)))
    if c.name in PARAGRAPHS:
        return (c.size > 80 and links < 0.25) or (c.size <= 80 and not c.linked and _sentence(c))
    if c.name in ("ul", "ol", "dl", "table", "figure"):
        return links < 0.3
    return c.name in ("div", "section") and links < 0.2 and (_holds(c, HEADINGS) or any(
        n.name in PARAGRAPHS and _sentence(n) for n in c.children if not isinstance(n, str)))


def main_nodes(root: Node) -> list[Node]:
    """The best container and what belongs to it, in page order."""
    order = _measure(root)
    score(order)
    scored = [n for n in order if n.score > 0 and n.name not in ("#root",)]
    if not scored:
        return [root] if root.size else []
    best = max(scored, key=lambda n: n.score)  # ties: the first
    out, node = [best], best
    while node.parent is not None:
        beside = [c for c in node.parent.children if c is node or (
            not isinstance(c, str) and _belongs(c, best, node is best))]
        at = beside.index(node)
        out = beside[:at] + out + beside[at + 1:]
        node = node.parent
        # An article holds all that is its own.
        if node.name in ("article", "main") or best.name in ("article", "main"):
            break
    return out


def blocks(nodes: list[Node]) -> Iterator[str]:
    """Text of each block in page order."""
    part: list[str] = []

    def done():
        text = " ".join(_html.unescape("".join(part)).split())
        part.clear()
        return text

    for top in nodes:
        stack: list[tuple[Node, Iterator]] = [(top, iter(top.children))]
        yield done()
        while stack:
            node, children = stack[-1]
            c = next(children, None)
            if c is None:
                stack.pop()
                if node.name in BLOCKS:
                    yield done()
            elif isinstance(c, str):
                part.append(c)
            elif c.name == "br":
                part.append(" ")
            else:
                if c.name in BLOCKS:
                    yield done()
                stack.append((c, iter(c.children)))
        yield done()


def main_text(page: str | None) -> str:
    return "\n".join(b for b in blocks(main_nodes(parse(page or ""))) if b)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with text and n_chars."""
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    own = unused("__html", keep)
    inner = pages.select(F.col(f"`{html}`").cast("string").alias(own), *[F.col(f"`{c}`") for c in keep])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [main_text(p) for p in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[*keep, "text", "n_chars"])

    return inner.mapInArrow(run, StructType(inner.drop(own).schema.fields + [
        StructField("text", StringType()), StructField("n_chars", LongType())]))
