"""Main text of web pages by composite text density.

Each page becomes a tree. For every node: C characters, T tags, and the L
characters and tags inside links; its composite density is C / T, turned down by
the logarithm of how much of it is links. A node's density sum adds those of its
children. The node with the largest sum is the core of the article; the least
density on the path from it to the body is the threshold above which a sibling of
the path belongs to the article too. Of an <article> or <main> around the core all
is taken but siblings of the path below that threshold that are mostly links.

Parts that are no text of an article whatever their density (scripts, forms,
menus, and what a class, id or role calls an advert, notice, comment and so on)
are cut first, whatever their length. A part that is named for the page's layout
(a "sidebar-page") is kept if it wraps the page's first h1, its article or main,
or if nothing would be left without it; comments, adverts and notices are not, but
where they wrap main. A form that has more text than all that is in no form wraps the
page, too, and its labels and controls alone are cut. Inside an article or main, a
name that may also be a section's ("related-work", "discussion", "warning") cuts only
with a second sign: mostly links, something named for what readers write, or, for
lists of teasers, no long block. What a style hides is cut as what is hidden. An article whose h1 was cut for a class of its own or
of what holds it (an "entry-header") gets it back.

Defined results: a null or empty page, or one without text, gives ""; of nodes with
equal sums the first by level, then place, is the core; repeated pages give equal rows;
extract() keeps all columns and takes the place of those named text and n_chars. A
page is held whole by a task, some hundred bytes for each tag. Broken
markup is read as browsers do in the cases that matter here: paragraphs and list
items end where the next begins, end tags without a start are ignored.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches

#: What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg math".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr option legend".split())
#: An element's start tag ends these open elements, up to the nearest of the others.
ENDED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements, roles and words of classes and ids that are no part of an article.
CUT_TAGS = frozenset("head nav footer aside form button select dialog object applet audio video canvas menu fieldset".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status".split())
CUT_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments commentlist discussion disqus replies responses cookie cookies consent gdpr notice notices alert warning popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager skip".split()
)
#: Those of them that no heading or article inside brings back, and those that are like a header.
NEVER_TAGS = frozenset("head nav footer aside form button select fieldset".split())
NEVER_ROLES = frozenset("search alert alertdialog dialog form status".split())
NEVER_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist discussion disqus replies responses cookie cookies consent gdpr notice notices alert warning newsletter subscribe subscription signup login".split()
)
HEADER_WORDS = frozenset("banner breadcrumb breadcrumbs header masthead topbar menu nav navbar navigation toolbar".split())
#: Words that also name parts of a text; inside an article or main they need a second sign.
DOUBTFUL = frozenset("discussion warning related recommended promotion side menu skip share sharing social responses replies".split())
#: Those of them that short lines speak for, as a list of teasers; and the words of what readers write.
LISTS, READERS = DOUBTFUL - frozenset("discussion warning responses replies".split()), frozenset("comment comments reply username avatar commenter".split())
#: A block of so many characters is no teaser.
LONG_BLOCK = 80
#: What is a control's and no text, in a form that wraps a page.
CONTROLS = frozenset("label legend output datalist".split())
LAYOUT, HEADER, NEVER = 1, 2, 3

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_HINT = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "chars", "tags", "link_chars", "link_tags", "density", "total", "heading", "whole", "doubt", "readers")

    def __init__(self, tag: str, parent: Node | None, cut: int):
        self.tag, self.parent, self.cut = tag, parent, cut
        self.parts: list[Node | str] = []
        self.whole = self.parts  # with the parts that are cut
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.heading = tag == "h1"
        self.doubt: frozenset[str] = frozenset()  # the words for which it is cut, if all of them are doubtful
        self.readers = False  # whether it is named for what readers write


def _cut(tag: str, attributes: str) -> int:
    """0: no cut part; LAYOUT, HEADER or NEVER: one that may be kept for what it wraps, or not."""
    if tag in NEVER_TAGS:
        return NEVER
    found = HEADER if tag == "header" else LAYOUT if tag in CUT_TAGS else 0
    for m in _HINT.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
            found = max(found, LAYOUT)
        if name == "role" and value in CUT_ROLES:
            found = max(found, NEVER if value in NEVER_ROLES else HEADER)
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            words = CUT_WORDS.intersection(_WORD.findall(value))
            if words:
                found = max(found, NEVER if words & NEVER_WORDS else HEADER if words & HEADER_WORDS else LAYOUT)
        if name in ("class", "id") and tag == "article" and not frozenset(["comment", "comments", "ad", "advert", "promo", "sponsored", "related"]).isdisjoint(_WORD.findall(value)):
            return NEVER
    return found


def _without_names(m: re.Match) -> str:
    return "" if m[1].lower() in ("class", "id") else m[0]


def _named(attributes: str) -> set[str]:
    """The words of an element's class and id."""
    return {w for m in _HINT.finditer(attributes) if m[1].lower() in ("class", "id") for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower())}


def tree(page: str) -> Node:
    """The page's elements, with raw text and whatever is no text left out."""
    root = now = Node("html", None, 0)
    at, last = 0, page.rfind(">") + 1  # no tag ends after it
    while True:
        m = _TAG.search(page, at, last)
        text = page[at : m.start()] if m else page[at:].partition("<!--")[0]
        if text:
            now.parts.append(unescape(text) if "&" in text else text)
        if not m:
            return root
        at = m.end()
        if m[0].startswith("<!--") and not m[0].endswith("-->"):
            return root
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<![CDATA["):
                now.parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            node = now
            while node is not root and node.tag != tag:
                if tag not in BLOCKS and node.tag in BLOCKS:
                    node = root
                    break
                node = node.parent
            if node is not root:
                now = node.parent
            continue
        if tag in RAW:
            if not attributes.endswith("/") or tag in ("script", "style", "title", "textarea", "iframe"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in ENDS_PARAGRAPH:
            node = now
            while node is not root and node.tag not in BLOCKS:
                node = node.parent
            if node.tag == "p":
                now = node.parent
        if tag in ENDED_BY:
            ended, inside = ENDED_BY[tag]
            node = now
            while node is not root and node.tag not in ended and node.tag not in inside:
                node = node.parent
            if node.tag in ended:
                now = node.parent
        if tag in ("html", "body"):
            if tag == "body" and now is not root:
                now = root
            continue
        if tag == "br" or tag == "hr":
            now.parts.append(" ") if tag == "br" else now.parts.append(Node("hr", now, 0))
            continue
        if tag in VOID:
            continue
        node = Node(tag, now, _cut(tag, attributes))
        if attributes:
            named = _named(attributes)
            node.readers = not READERS.isdisjoint(named)
            words = CUT_WORDS & named
            if node.cut and words and words <= DOUBTFUL and tag not in CUT_TAGS and not _cut(tag, _HINT.sub(_without_names, attributes)):
                node.doubt = frozenset(words)
        now.parts.append(node)
        if not attributes.endswith("/") or tag in BLOCKS:
            now = node


def _measure(root: Node) -> list[Node]:
    """Counts from the leaves up; the nodes, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.parts if x.__class__ is Node]
    for node in reversed(order):
        node.tags = 1
        node.chars = node.link_chars = node.link_tags = 0
        node.heading = node.tag == "h1"
        for x in node.parts:
            if x.__class__ is Node:
                node.chars += x.chars
                node.tags += x.tags
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
                node.heading |= x.heading
            else:
                node.chars += len(x.strip())
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    return order


def _densities(order: list[Node]) -> None:
    body = order[0]
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(order):
        c, t, lc, lt = node.chars, node.tags, max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + e)
            node.density = c / t * max(log(max(c / lc * t / lt, 1.0)) / log(base) if base > 1.0001 else log(max(c / lc * t / lt, 1.0)), 0.0)
        node.total = sum(x.density for x in node.parts if x.__class__ is Node)


def _keep_doubtful(order: list[Node]) -> None:
    """Takes the cut from parts of an article or main whose names may be those of its sections, unless a second sign speaks for the cut.

    Signs: most of it is links, something in it is named for what readers write, or, for
    lists of teasers, no block is long.
    """
    for node in order:
        if node.doubt and any(_inside(node, x) for x in ("article", "main")):
            inside = _in_page_order(node)
            links = 2 * node.link_chars > node.chars
            readers = any(x.readers for x in inside)
            short = node.doubt <= LISTS and max((len(b) for b in blocks(node)), default=0) < LONG_BLOCK
            if not (links or readers or short):
                node.cut = 0


def _keep_forms(root: Node, order: list[Node]) -> None:
    """Takes the cut from a form that wraps the page: beside its controls it has more text than all that is in no form."""
    forms = [n for n in order if n.tag == "form" and not _inside(n, "form")]
    if not forms:
        return
    outside = root.chars - sum(n.chars for n in order if n.tag in ("form", "script", "head") and not _inside(n, "form") or n.cut and n.tag != "form" and not _inside_cut(n) and not _inside(n, "form"))
    for form in forms:
        inside = [n for n in _in_page_order(form) if n is not form]
        controls = sum(n.chars for n in inside if n.tag in CONTROLS and not any(_inside(n, t) for t in CONTROLS) or n.cut == NEVER and n.tag != "form")
        holds = any(n.tag in ("main", "article", "h1") for n in inside)
        if form.chars - controls > max(outside, 0) and (holds or any(n.tag == "p" for n in inside)):
            form.cut = 0
            for n in inside:
                if n.tag in CONTROLS:
                    n.cut = NEVER


def _keep_wrappers(root: Node, order: list[Node]) -> None:
    """Takes the cut from parts that wrap the page's article."""
    above = {id(root): 0}  # the gravest cut among a node and those around it
    for node in order:
        if node is not root:
            above[id(node)] = max(above[id(node.parent)], node.cut)
    if not any(node.cut and node.chars for node in order):
        return
    marks = [n for n in _in_page_order(root) if n.tag in ("h1", "article", "main")]
    bare = {n.tag for n in marks if not above[id(n)]}
    kept: set[int] = set()

    def keep(node: Node, most: int, more: int = 0) -> None:
        while node.parent is not None:
            node = node.parent
            if 0 < node.cut <= most and node.tag not in NEVER_TAGS and node.chars >= more:
                kept.add(id(node))

    for tag in ("main", "article", "h1"):
        own = [n for n in marks if n.tag == tag and (tag == "main" or above[id(n)] < NEVER)]
        if own and bare.isdisjoint(("main", "article") if tag != "h1" else ("main", "article", "h1")):
            # beside a heading, an article inside a cut part may be a teaser: the part has to outweigh the rest
            keep(own[0], {"main": NEVER, "article": HEADER, "h1": LAYOUT}[tag], root.chars // 2 + 1 if tag == "article" and "h1" in bare else 0)
            break
    for node in order:
        if id(node) in kept or node.cut == HEADER and node.heading and any(_inside(node, x) for x in ("article", "main")):
            node.cut = 0
    left = root.chars - sum(n.chars for n in order if n.cut and not _inside_cut(n))
    if left <= 0:
        for node in order:
            if node.cut < NEVER:
                node.cut = 0


def _inside_cut(node: Node) -> bool:
    while node.parent is not None:
        node = node.parent
        if node.cut:
            return True
    return False


def main_nodes(root: Node) -> list[Node]:
    """The nodes whose text is the article's, in page order."""
    order = _measure(root)
    _keep_forms(root, order)
    _keep_doubtful(order)
    _keep_wrappers(root, order)
    kept, core, top = _densest(root, order)
    if not any(n.heading for n in kept):
        lost = _lost_title(root, core, top)
        if lost:
            for node in lost:
                node.cut = 0
            kept, _, _ = _densest(root, order)
    return kept


def _densest(root: Node, order: list[Node]) -> tuple[list[Node], Node, Node | None]:
    """(the article's nodes, the one with the largest density sum, the article or main around it if there is one)."""
    for node in order:
        node.parts = [x for x in node.whole if x.__class__ is not Node or not x.cut] if not node.cut else node.whole
    order = _measure(root)
    _densities(order)
    core = max(order, key=lambda n: n.total)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    around = [i for i, n in enumerate(path) if n.tag in ("article", "main")]
    if around:
        # all of it but siblings of the path that are less dense than the path because of their links
        inside = path[: around[-1] + 1]
        threshold = min(n.density for n in inside)
        for node, parent in zip(inside, inside[1:], strict=False):
            parent.parts = [x for x in parent.parts if x.__class__ is not Node or x is node or x.density >= threshold or 2 * x.link_chars <= x.chars]
        return [inside[-1]], core, inside[-1]
    threshold = min(n.density for n in path)
    kept = {id(core)}
    for node, parent in zip(path, path[1:], strict=False):
        kept |= {id(x) for x in parent.parts if x.__class__ is Node and x is not node and x.chars and (x.density >= threshold and x.density > 0 or node is core and x.heading and not core.heading)}
    return [n for n in _in_page_order(root) if id(n) in kept], core, None


def _lost_title(root: Node, core: Node, top: Node | None) -> list[Node]:
    """The cut nodes around the first h1 that stands in the article but for its own class or that of what holds it."""
    near = {id(core), id(top or (core.parent if core.parent is not root else None) or core)}
    for title in (n for n in _in_page_order(root, whole=True) if n.tag == "h1" and n.chars):
        lost, node = [], title
        while node is not None and id(node) not in near:
            if node.cut:
                lost.append(node)
            node = node.parent
        if node is not None and lost and all(n.tag not in NEVER_TAGS and n.tag != "header" and (n.cut < NEVER or n is title) for n in lost):
            return lost
    return []


def _inside(node: Node, tag: str) -> bool:
    while node.parent is not None:
        node = node.parent
        if node.tag == tag:
            return True
    return False


def _in_page_order(root: Node, whole: bool = False) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.whole if whole else node.parts) if x.__class__ is Node]
    return out


def blocks(node: Node) -> list[str]:
    """The text of a node's blocks: white space is one space, blocks without text are left out."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif x.__class__ is Node:
            if x.tag in BLOCKS:
                end()
                todo.append(None)
            todo += reversed(x.parts)
        else:
            line.append(x)
    end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(b for node in main_nodes(tree(page)) for b in blocks(node))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with the columns text, the article of each page, and n_chars, its code points."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text(htmls):
        import pandas as pd

        return pd.Series([main_text(h) for h in htmls], dtype=object)

    return pages.withColumn("text", text(F.col(html))).withColumn("n_chars", F.length("text").cast("bigint"))
