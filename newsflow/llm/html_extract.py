"""Main text of a page by tree scoring.

A tolerant parse builds the element tree.  Every paragraph passes points (one,
plus one per comma, plus length) to its ancestors, less the further up; a
container's points are discounted by its link density.  The best container, or
the article or main element around it, and its siblings that score well are
kept, without subtrees that are menus, adverts, forms, comments and the like, by
their tag, role, hiding attributes, or class and id names.  None of these drops what is
around the main element, around the article or (without an article elsewhere) around most
of the page's points: a form or an unclosed menu around the article is a wrapper.  Names
don't count for headings, after "has", "no" or "with", nor for ids that are slugs inside the
article; a page that is empty by all that is read with all but scripts, controls and media.

A null, empty or text-free page gives an empty text.  Columns of the page are
independent: equal rows give equal results.  Any nesting depth is handled
without recursion; unclosed and stray tags follow the usual implied closing.  Time is
linear in the page: what is open is kept by tag, so no tag searches its ancestors.
"""

from __future__ import annotations

import gc
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from .tables import map_column

# --- fixed values -----------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("script style noscript template button select textarea iframe svg math object canvas audio video "
                         "head title datalist".split())
# dropped unless they are around the article
LAYOUT_TAGS = frozenset("nav footer aside form dialog menu fieldset header".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                          "form toolbar".split())
DROPPED_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
                          "banner cookie cookies consent gdpr notice sidebar aside comment comments discussion disqus "
                          "respond replies share sharing social related recommended newsletter subscribe subscription "
                          "signup login nav navbar navigation menu breadcrumb breadcrumbs footer header masthead popup "
                          "modal overlay widget toolbar pagination pager outbrain taboola alert disclaimer copyright".split())
# beginnings of compound names such as commentlist, sidebarleft, cookiebar
DROPPED_STARTS = ("advert", "sponsor", "cookie", "sidebar", "newsletter", "breadcrumb", "footer", "navbar", "commentl",
                  "commentf", "commentsec", "commentbox", "commentth", "disqus", "subscrib")
# names of parts that may hold more text than the article; the others are names of layout
CROWDS = ("comment", "disqus", "discussion", "respond", "replies", "related", "recommended", "outbrain", "taboola",
          "sponsor", "promo", "ad", "cookie", "consent", "gdpr", "newsletter", "subscri", "disclaimer", "notice",
          "tag:aside", "tag:footer", "tag:dialog", "tag:menu", "role:complementary", "role:contentinfo", "role:dialog",
          "role:alert", "role:menu")
NOT_SLUGS = ("comment", "disqus", "respond")
MODIFIERS = frozenset("has have no not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre div section article main body html table thead "
                   "tbody tfoot tr td th caption figure figcaption address header footer aside nav form hr details "
                   "summary center fieldset".split())
ENDS_P = BLOCKS
# opening one of these closes an open element of the named kinds
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
           "tfoot": ("tr", "td", "th", "tbody")}
LIST_SCOPE = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
              "th": ("tr", "table"), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}
PARAGRAPHS = frozenset("p pre blockquote td".split())
BASE = {"article": 10.0, "main": 10.0, "div": 5.0, "section": 3.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0,
        "ol": -3.0, "dl": -3.0, "li": -3.0, "th": -5.0, "header": -5.0}
COMMA = re.compile("[,،、，]")
MIN_PARAGRAPH = 25
REACH = 5                 # ancestors that get points
SPLIT_NAMES = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


# what start tags look for: (tags that they close, nearer tags that keep those open)
P_SCOPE = ("td", "th", "button", "table", "article", "section", "div", "body")
CLOSES = {"p": (frozenset("p".split()), frozenset(P_SCOPE)),
          **{t: (frozenset(IMPLIED[t]), frozenset(LIST_SCOPE[t])) for t in IMPLIED}}
WATCHED: dict[str, list[str]] = {}
for _kind, (_tags, _scope) in CLOSES.items():
    for _t in _tags | _scope:
        WATCHED.setdefault(_t, []).append(_kind)


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "named", "slug", "score", "chars", "link_chars", "depth", "within")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, named: str = "", slug: str = ""):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.named, self.slug = named, slug     # what of the tag, role or class, and of the id, tells a part to drop
        self.children: list = []
        self.score = BASE.get(tag, 0.0)
        self.chars = self.link_chars = 0
        self.depth = parent.depth + 1 if parent is not None else 0
        # article and main elements around it
        self.within = frozenset() if parent is None else parent.within | {parent.tag} if (
            parent.tag in ("article", "main")) else parent.within


def layout(tag: str, attrs: list, inside_article: bool) -> str:
    """What tells that an element is none of the article, whatever its names."""
    found = []
    if tag in LAYOUT_TAGS and not (tag == "header" and inside_article):
        found.append(f"tag:{tag}")
    for name, value in attrs:
        value = (value or "").lower()
        if name == "role" and value in DROPPED_ROLES:
            found.append(f"role:{value}")
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            found.append("hidden")
        elif name == "style" and "display:none" in value.replace(" ", ""):
            found.append("hidden")
    return " ".join(found)


def dropped_names(tag: str, value: str) -> str:
    """The words of a class or id that tell a part to drop."""
    if tag in HEADINGS or tag in ("body", "html") or tag in ("article", "main") and "comment" not in value.lower():
        return ""
    found = []
    for token in CAMEL.sub("-", value).lower().split():
        for w in SPLIT_NAMES.split(token):
            if w in MODIFIERS:
                break
            if w in DROPPED_WORDS or w.startswith(DROPPED_STARTS):
                found.append(w)
    return " ".join(found)


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None, False)
        self.named: list[Node] = []
        self.opened: dict[str, list[Node]] = {}           # open elements by tag, the innermost last
        self.blocks: list[Node] = []                      # open blocks
        self.near: dict[str, list[Node]] = {kind: [] for kind in CLOSES}

    def _open(self, node: Node) -> None:
        self.opened.setdefault(node.tag, []).append(node)
        if node.tag in BLOCKS:
            self.blocks.append(node)
        for kind in WATCHED.get(node.tag, ()):
            self.near[kind].append(node)
        self.at = node

    def _close(self, last: Node) -> None:
        """Closes all open elements down from ``last``; each is closed once."""
        node = None
        while node is not last:
            node = self.at
            self.opened[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()
            for kind in WATCHED.get(node.tag, ()):
                self.near[kind].pop()
            self.at = node.parent

    def _imply(self, kind: str) -> None:
        """Closes the nearest open element that a start tag of this kind ends, if none of its scope is nearer."""
        near = self.near[kind]
        if near and near[-1].tag in CLOSES[kind][0]:
            self._close(near[-1])

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._imply("p")
        if tag in IMPLIED:
            self._imply(tag)
        up = self.at
        if tag in ("body", "html") and up.tag == "body":
            return
        new = Node(tag, up, up.dropped or tag in DROPPED_TAGS)
        if not new.dropped:
            if attrs or tag in LAYOUT_TAGS:
                new.named = layout(tag, attrs, bool(self.opened.get("article") or self.opened.get("main")))
            for name, value in attrs:
                if name == "class" and value:
                    new.named = f"{new.named} {dropped_names(tag, value)}".strip()
                elif name == "id" and value:
                    new.slug = dropped_names(tag, value)
            if new.named or new.slug:
                self.named.append(new)
        up.children.append(new)
        if tag not in VOID:
            self._open(new)

    def handle_startendtag(self, tag, attrs):
        before = self.at
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at is not before and self.at.tag == tag:
            self._close(self.at)

    def handle_endtag(self, tag):
        if tag in ("body", "html") or not self.opened.get(tag):
            return
        node = self.opened[tag][-1]
        # an inline end tag doesn't close blocks around it
        if tag not in BLOCKS and self.blocks and self.blocks[-1].depth > node.depth:
            return
        self._close(node)

    def handle_data(self, data):
        if not self.at.dropped:
            self.at.children.append(data)


def parse(html: str, by_name: bool = True) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    if by_name and builder.named:
        drop_named(builder.root, builder.named)
    return builder.root


def _preorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        out.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return out


def _measure(nodes: list[Node]) -> dict:
    """Characters, those in links (both kept in the nodes) and commas of every node."""
    commas: dict = {}
    for node in nodes:
        node.chars = node.link_chars = 0
    for node in reversed(nodes):                      # children before parents
        own = [c for c in node.children if isinstance(c, str)]
        node.chars += sum(len(c.strip()) for c in own)
        commas[node] = commas.get(node, 0) + sum(len(COMMA.findall(c)) for c in own)
        if node.tag == "a":
            node.link_chars = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            commas[node.parent] = commas.get(node.parent, 0) + commas[node]
    return commas


def _points(node: Node, commas: dict) -> float | None:
    """What a paragraph passes on; None for what isn't one."""
    if (node.tag in PARAGRAPHS or node.tag == "div" and not any(
            not isinstance(c, str) and c.tag in BLOCKS for c in node.children)) and node.chars >= MIN_PARAGRAPH:
        return (1 + commas[node] + min(3.0, node.chars / 100)) * (1 - node.link_chars / node.chars)
    return None


def _is_slug(node: Node) -> bool:
    """True for an id inside the article or main element that names a section of it."""
    around = node.within
    if node.slug.startswith(NOT_SLUGS) or around.isdisjoint(("article", "main")):
        return False
    if "article" in around and node.tag != "div":
        return True
    first = next((c for c in node.children if not isinstance(c, str) or c.strip()), None)
    if first is None or isinstance(first, str) or first.tag not in HEADINGS:
        return False
    words = SPLIT_NAMES.split(" ".join(blocks([first])).lower())
    return all(w in words for w in node.slug.split())


def drop_named(root: Node, named: list[Node]) -> None:
    """Drops the elements that their names tell, but not what is around the article."""
    for node in named:
        if node.slug and not _is_slug(node):
            node.named = f"{node.named} {node.slug}".strip()
    named = [n for n in named if n.named]
    if not named:
        return
    nodes = _preorder(root)
    commas = _measure(nodes)
    crowds = {n for n in named if any(w.startswith(CROWDS) for w in n.named.split())}
    below: dict = {}                                  # points below a node, with and without those of crowds in it
    for node in reversed(nodes):
        own = _points(node, commas) or 0.0
        every, plain = below.get(node, (0.0, 0.0))
        below[node] = every, plain = every + own, plain + own
        if node.parent is not None:
            up = below.get(node.parent, (0.0, 0.0))
            below[node.parent] = up[0] + every, up[1] + (0.0 if node in crowds else plain)
    half = below[root][1] / 2
    around: set = set()
    apart = False                                     # an article stands outside all named elements
    under: dict = {}                                  # whether a node or one around it is named
    for node in nodes:
        under[node] = bool(node.named) or under.get(node.parent, False)
        if node.tag in ("article", "main") and not node.named and node.chars:
            if node.tag == "main" or below[node][1] > half:
                up = node
                while up is not None and up not in around:
                    around.add(up)
                    up = up.parent
            apart = apart or not under[node]
    for node in named:
        node.dropped = not (node in around or not apart and node not in crowds and below[node][1] > half)


def best_container(root: Node) -> list[Node]:
    """The kept nodes: the best container and its good siblings, in page order."""
    nodes = _preorder(root)
    commas = _measure(nodes)
    got = set()
    for node in nodes:
        points = _points(node, commas)
        if points is not None:
            up, level = node.parent, 0
            while up is not None and level < REACH:
                up.score += points / (1 if level == 0 else 2 * level)
                got.add(up)
                up, level = up.parent, level + 1
    if not got:
        return [next((n for t in ("article", "main", "body") for n in nodes if n.tag == t), root)]
    worth = {n: n.score * (1 - n.link_chars / n.chars if n.chars else 1.0) for n in got}
    top = max((n for n in nodes if n in got), key=lambda n: worth[n])
    node = top
    while node is not None:                           # the whole article, not one of its sections
        if node.tag in ("article", "main"):
            top = node
        node = node.parent
    if top.tag in ("article", "main") or top.parent is None:
        return [top]
    limit = max(10.0, 0.2 * worth[top])
    kept = []
    for c in top.parent.children:
        if isinstance(c, str) or c.dropped:
            continue
        good = c.tag == "p" and c.chars >= 80 and c.link_chars < 0.25 * c.chars
        if c is top or worth.get(c, 0.0) >= limit or good or c.tag in ("h1", "h2"):
            kept.append(c)
    return kept


def blocks(kept: list[Node]) -> list[str]:
    """Texts of the blocks below the kept nodes, white space collapsed."""
    out, run = [], []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    for top in kept:
        stack: list = [top]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                run.append(x)
            elif not x.dropped:
                if x.tag == "br":
                    run.append(" ")
                    continue
                if x.tag in BLOCKS:
                    flush()
                    stack.append(None)
                stack.extend(reversed(x.children))
        flush()
    return out


def closed_comments(html: str) -> str:
    """The page without the marks of comments that never end: what follows them is text."""
    at = html.find("<!--", html.rfind("-->") + 1)
    return html if at < 0 else html[:at] + html[at:].replace("<!--", "")


def main_text(html: str | None) -> str:
    if not html:
        return ""
    html = closed_comments(html)
    collecting = gc.isenabled()
    gc.disable()                      # a large tree would be walked again and again while it grows
    try:
        text = "\n\n".join(blocks(best_container(parse(html))))
        return text if text else "\n\n".join(blocks(best_container(parse(html, by_name=False))))
    finally:
        if collecting:
            gc.enable()


def _extract_all(pages: list) -> dict:
    text = [main_text(h) for h in pages]
    return {"text": text, "n_chars": [len(t) for t in text]}


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return map_column(pages, ["page_id", "url"], "html", _extract_all, {"text": "string", "n_chars": "long"})
