"""Main text of web pages by tree scoring.

A page becomes a tree of elements (unclosed paragraphs, list items and table
cells end where the next one starts; scripts, styles and the like hold no
markup).  Regions that are not part of an article by their tag, role or class
(navigation, page headers and footers, sidebars, notices, adverts, forms, reader
comments) are left out.  Ids that are slugs of the text are not judged, nor are
paragraphs and headings of an article by a word of their class, and a region whose
name alone speaks against it stays if its text scores as prose does.  Every block of text passes points for its length and its commas to its
ancestors, half of them a level up; an element's points are discounted by the
share of its text that stands in links.  The best container is kept; from it,
the way leads up to the outermost one whose other parts are mostly unlinked
prose, and all its text is kept but for blocks that are mainly links and score
little.  Where the page marks its articles, they are taken whole, all those of
prose, with the page's title above them.  Time is linear in the page.

Text of a block: character references decoded, white space joined to one space,
trimmed; blocks in page order are joined by an empty line.

Defined results: null, empty and text-free pages give an empty text; markup
that ends early is closed at the end, an unfinished tag there is dropped;
repeated rows get equal results; whole pages are used, however long; a table
without rows gives none; other columns of any name are kept, except one called as
the result, whose name can be chosen.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from rawhouse.llm.common import map_texts

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value after "=" only.  Nothing is tried twice (possessive).
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\s\"']))[^>=]*+)*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
_LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Elements whose content is not markup; their text is never page text.
_RAW = frozenset(("script", "style", "textarea", "noscript", "template", "title", "iframe", "noframes", "svg", "math"))
_VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
_BLOCK = frozenset(
    (
        "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
        "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
        "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
        "tfoot", "th", "thead", "tr", "ul",
    )
)
# Start tags that end an open element of these kinds, up to the given border.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
_SCOPE = frozenset(("html", "body", "div", "article", "section", "main", "table", "td", "th", "ul", "ol", "blockquote", "aside", "header", "footer", "nav", "form", "button", "figure", "details"))
_SKIP_TAGS = frozenset(
    ("head", "nav", "aside", "form", "button", "select", "menu", "dialog", "object", "embed", "canvas", "audio", "video", "label", "input")
)
_SKIP_ROLES = frozenset(
    ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form", "toolbar")
)
_SKIP_WORDS = frozenset(
    (
        "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "byline",
        "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr",
        "hidden", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
        "outbrain", "overlay", "pager", "pagination", "paywall", "popup", "privacy", "promo", "promoted", "recommended",
        "related", "remark", "replies", "respond", "search", "share", "sharing", "shoutbox", "sidebar", "sidebars",
        "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "taboola", "tags", "toolbar",
        "toc", "topbar", "widget", "widgets",
    )
)
_GOOD_WORDS = frozenset(
    ("article", "articles", "body", "blog", "content", "contents", "entry", "hentry", "main", "page", "post", "prose", "story", "text")
)


_ABOUT_WORDS = frozenset(("has", "with", "no", "without"))  # "has-sidebar" names a page's layout
# Words that only name a part of a layout: "comment-list" says as much as "comments".
_FRAME_WORDS = _GOOD_WORDS | frozenset(
    (
        "area", "bar", "block", "bottom", "box", "button", "buttons", "col", "column", "container", "cta", "form", "global", "header",
        "heading", "holder", "icon", "icons", "inner", "inline", "item", "items", "label", "left", "link", "links", "list", "outer",
        "panel", "posts", "primary", "region", "results", "right", "row", "secondary", "section", "site", "slot", "sticky", "stories",
        "title", "top", "unit", "wrap", "wrapper", "zone",
    )
)
# Regions that may hold long prose and still are none of the article's: reader
# comments, notices, adverts, sidebars, footers, navigation.
_APART_WORDS = frozenset(
    (
        "ad", "ads", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "comment", "comments",
        "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "nav", "navbar", "navigation",
        "newsletter", "notice", "notices", "outbrain", "remark", "replies", "respond", "shoutbox", "sidebar", "sidebars", "sponsored",
        "taboola",
    )
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_PROSE_TAGS = _HEADINGS | {"p", "pre", "blockquote", "ul", "ol", "dl", "table"}
_ID_TAGS = frozenset(("div", "section", "ul", "ol", "dl", "table", "td"))  # elsewhere an id is an anchor in the text
_LEAST = 2.0  # points of a text that is prose whatever its region is called
# Words that speak against a paragraph or a heading inside an article too.
_NEVER_WORDS = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "sponsored", "taboola"))

# Which open elements a start tag's rule looks at, by the tag that opens or borders them.
_OPENS = {t: tuple(n for n, (kinds, _) in _CLOSES.items() if t in kinds) for t in {k for kinds, _ in _CLOSES.values() for k in kinds}}
_BORDERS = {t: tuple(n for n, (_, edge) in _CLOSES.items() if t in edge) for t in {b for _, edge in _CLOSES.values() for b in edge}}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "points", "chars", "linked", "paragraph", "items")

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        # The open paragraph around the element, and the outermost open item for each
        # start tag that would end it, so that no start tag walks up the tree.
        self.paragraph: Node | None = self if tag == "p" else None if parent is None or tag in _SCOPE else parent.paragraph
        self.items: dict[str, Node] = parent.items if parent is not None else {}
        if tag in _OPENS or tag in _BORDERS:
            self.items = {n: v for n, v in self.items.items() if n not in _BORDERS.get(tag, ())}
            for n in _OPENS.get(tag, ()):
                self.items.setdefault(n, self)
        self.children: list[Node | str] = []
        self.points = 0.0
        self.chars = 0  # text below, and the part of it in links
        self.linked = 0


_END = Node("div", "", None)  # between the texts of two blocks


def build_tree(page: str) -> Node:
    """The element tree of a page."""
    root = Node("html", "", None)
    here, at = root, 0
    open_tags: dict[str, int] = {}  # how many of a name are open, so that a stray end tag costs nothing

    def leave(to: Node) -> Node:
        up = here
        while up is not to:
            open_tags[up.tag] -= 1
            up = up.parent
        return to

    while (m := _TAG.search(page, at)) is not None:  # from `at`: raw content is never read as tags
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        name, attrs, closing = m[2], m[3], m[1]
        if name is None:
            text = m[0]
            if text[1] in "!?" or not text.endswith(">"):
                continue
            loose = _LOOSE.match(text)  # a quote that is never closed
            name, attrs, closing = loose[1], "", "/" if text[1] == "/" else ""
        name = name.lower()
        if closing:
            if open_tags.get(name):
                up = here
                while up.tag != name:
                    up = up.parent
                here = leave(up.parent)
            continue
        if name in ("html", "body"):
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _BLOCK or name == "option":  # ends an open paragraph, and the items before it
            if here.paragraph is not None:
                here = leave(here.paragraph.parent)
            if name in here.items:
                here = leave(here.items[name].parent)
        node = Node(name, attrs, here)
        here.children.append(node)
        if name not in _VOID and not attrs.endswith("/"):
            here = node
            open_tags[name] = open_tags.get(name, 0) + 1
    if at < len(page):
        here.children.append(page[at:])
    return root


def _names_of(attrs: str) -> tuple[list[set[str]], list[set[str]], str, bool]:
    """The words of each class name and of the id (lower-cased), the role, and
    whether the element is hidden."""
    classes: list[set[str]] = []
    ids: list[set[str]] = []
    role, hidden = "", False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            (classes if name == "class" else ids).extend({w.lower() for w in _PIECES.findall(part)} for part in value.split())
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden":
            hidden |= value.strip().lower() != "until-found"
        elif name == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
    return classes, ids, role, hidden


def _words_of(attrs: str) -> set[str]:
    classes, ids, _, _ = _names_of(attrs)
    return set().union(*classes, *ids)


def _left_out(node: Node, in_article: bool) -> bool | None:
    """Whether a region is not part of an article; None: by its name only, so
    its text decides."""
    if node.tag in ("article", "main"):
        if not in_article:
            return bool(node.attrs) and _names_of(node.attrs)[3]
    elif node.tag == "label" and in_article:
        pass  # a word for a thing; a form's labels go with the form
    elif node.tag in _SKIP_TAGS or node.tag == "footer" or (node.tag == "header" and not in_article):
        return True
    if not node.attrs:
        return False
    classes, ids, role, hidden = _names_of(node.attrs)
    if hidden or role in _SKIP_ROLES:
        return True
    if node.tag in ("body", "h1") or any(len(n) == 1 and n <= _GOOD_WORDS for n in classes + ids):
        return False  # a name that says article on its own
    section = node.tag == "section" or {"section"} in classes
    if node.tag not in _ID_TAGS or (section and in_article):
        ids = []  # a slug of the text
    named = [n for n in classes + ids if n & _SKIP_WORDS and not n & _ABOUT_WORDS]
    whole = [n for n in named if n <= _SKIP_WORDS | _FRAME_WORDS]
    if in_article and (node.tag in _HEADINGS or node.tag in ("p", "pre", "blockquote") or node.tag not in _BLOCK):
        return any(n & _NEVER_WORDS for n in whole)  # a word about a paragraph of the article
    if any(n & _APART_WORDS for n in whole):
        return True
    if node.tag in _HEADINGS or node.tag not in _BLOCK:
        return bool(whole)  # too short for a judgement by its text
    if in_article or section:  # "search-algorithms" is a slug, "search-box" is not
        named = [n for n in named if n in classes or n in whole]
    return None if named else False


def _gain(node: Node, apart: float = 0.0) -> float:
    """Points of an element's own block of text; sets its characters, and those of
    them in links, from those of its children.  Commas count where they are
    ``apart`` characters apart on average (a list of words has more)."""
    own = [html.unescape(c) if "&" in c else c for c in node.children if isinstance(c, str)]
    below = [c for c in node.children if not isinstance(c, str)]
    text = sum(len(c.strip()) for c in own)
    inline = [c for c in below if c.tag not in _BLOCK]
    node.chars = text + sum(c.chars for c in below)
    node.linked = node.chars if node.tag == "a" else sum(c.linked for c in below)
    block = text + sum(c.chars for c in inline)
    if node.tag not in _BLOCK or not block:
        return 0.0
    prose = block - sum(c.linked for c in inline)
    commas = sum(c.count(",") + c.count("，") + c.count("、") for c in own)
    commas = min(commas, block / apart) if apart else commas
    return (0.1 + min(block / 100.0, 3.0) + commas) * prose / block


def _measure(root: Node) -> None:
    """Points of all blocks below each element, undiminished."""
    for node, leaving in _in_order(root):
        if leaving:
            node.points = _gain(node, 25.0) + sum(c.points for c in node.children if not isinstance(c, str))


def prune(root: Node) -> None:
    """Drop the regions that are not part of an article.  One that is so by its
    name only stays if its blocks score as prose does, discounted by its links."""
    todo, measured = [(root, False)], False
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in ("article", "main")
        kept: list[Node | str] = []
        for c in node.children:
            out = False if isinstance(c, str) else _left_out(c, inside)
            if out is None:
                if not measured:
                    _measure(root)
                    measured = True
                out = not c.chars or c.points * (1 - c.linked / c.chars) < _LEAST
            if not out:
                kept.append(c)
        node.children = kept
        todo += [(c, inside) for c in kept if not isinstance(c, str)]


def _in_order(root: Node) -> list[tuple[Node, bool]]:
    """(element, whether it is left now) in page order, without recursion."""
    out, todo = [], [(root, False)]
    while todo:
        node, leaving = todo.pop()
        out.append((node, leaving))
        if not leaving:
            todo.append((node, True))
            todo += [(c, False) for c in reversed(node.children) if not isinstance(c, str)]
    return out


def score(root: Node) -> Node | None:
    """Pass points up the tree; the best container, or None without text."""
    nodes = _in_order(root)
    for node, _ in nodes:
        node.points = 0.0
    for node, leaving in nodes:
        if leaving and (gain := _gain(node)):
            up, share = node.parent if node.tag != "div" or node.parent is None else node, 1.0
            while up is not None and share > 0.05:
                up.points += gain * share
                up, share = up.parent, share / 2
    best, top = None, 0.0
    for node, leaving in nodes:
        if leaving or not node.points:
            continue
        points = node.points * (1 - (node.linked / node.chars if node.chars else 0.0))
        if node.tag in ("article", "main"):
            points *= 2
        elif node.attrs and _words_of(node.attrs) & _GOOD_WORDS:
            points *= 1.5
        node.points = points
        if points > top:
            best, top = node, points
    if best is None:
        return next((n for n, leaving in nodes if not leaving and n.chars), None)
    up = best.parent
    while up is not None:  # an article is taken whole
        if up.tag in ("article", "main"):
            return up
        up = up.parent
    return best


def _dense(node: Node) -> bool:
    return 2 * node.linked > node.chars


def _is_prose(node: Node) -> bool:
    """Text of an article: elements that hold prose, lists or tables, or a long
    text without them, and not mainly links."""
    if not node.chars or _dense(node):
        return False
    if node.chars > 80 or node.tag in _PROSE_TAGS:
        return True
    return any(not leaving and n.chars and n.tag in _PROSE_TAGS for n, leaving in _in_order(node))


def _articles(best: Node) -> list[Node | str]:
    """An article, the articles of prose beside it, and the title above the first
    if none of them has one: in page order."""
    root = best
    while root.parent is not None:
        root = root.parent
    found: list[Node] = []
    titles: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node is best or node.tag in ("article", "main") and _is_prose(node):
            found.append(node)
        elif node.tag == "h1" and node.chars and not found:
            titles.append(node)
        else:
            todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    if titles and not any(n.tag == "h1" and n.chars for one in found for n, _ in _in_order(one)):
        found.insert(0, titles[-1])
    return found


def _kept(best: Node) -> list[Node | str]:
    """The text of the outermost container whose parts around the best one are
    mostly unlinked prose, without poor blocks that are mainly links; around the
    best element itself, any prose is enough."""
    if best.parent is None:
        return [best]
    if best.tag in ("article", "main"):
        return _articles(best)
    top, here, beside = best, best, True
    while here.parent is not None:
        up = here.parent
        prose = sum(c.chars for c in up.children if c is not here and not isinstance(c, str) and c.tag in _BLOCK and _is_prose(c))
        links = sum(c.chars for c in up.children if c is not here and not isinstance(c, str) and _dense(c))
        bare = sum(len(c.strip()) if isinstance(c, str) else c.chars for c in up.children if isinstance(c, str) or c.tag not in _BLOCK)
        prose += bare if bare > 80 else 0
        if prose and (beside or prose >= links):
            top = up
        beside = beside and up.chars == here.chars
        here = up
    path, here = set(), best
    while here is not top:
        path.add(id(here))
        here = here.parent
    least, out, todo = max(2.0, 0.2 * best.points), [], [top]
    while todo:
        node = todo.pop()
        if isinstance(node, str) or node is best:
            out.append(node)
        elif node is top or id(node) in path:
            todo += [_END, *reversed(node.children), _END] if node.tag in _BLOCK else reversed(node.children)
        elif node is _END or node.tag not in _BLOCK or not _dense(node) or node.points >= least:
            out.append(node)
    return out


def blocks(nodes: list[Node | str]) -> list[str]:
    """Texts of the blocks below the nodes, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def end() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    todo: list = [(n, False) for n in reversed(nodes)]
    while todo:
        node, leaving = todo.pop()
        if isinstance(node, str):
            parts.append(html.unescape(node) if "&" in node else node)
            continue
        if node.tag in _BLOCK:
            end()
        elif node.tag == "br":
            parts.append(" ")
        if not leaving:
            todo.append((node, True))
            todo += [(c, False) for c in reversed(node.children)]
    end()
    return out


def main_text(page: str | None) -> str:
    """The main text of a whole page."""
    if not page:
        return ""
    root = build_tree(page)
    prune(root)
    best = score(root)
    return "\n\n".join(blocks(_kept(best))) if best is not None else ""


def extract_main_text(df: DataFrame, html_col: str = "html", keep: list[str] | None = None, out: str = "text") -> DataFrame:
    """Columns ``keep`` (default: all but the page and ``out``) with the main text."""
    kept = keep if keep is not None else [c for c in df.columns if c.lower() not in {out.lower(), html_col.lower()}]
    return map_texts(df, html_col, kept, {out: "string"}, lambda: lambda pages: {out: [main_text(p) for p in pages]})


__all__ = ["build_tree", "extract_main_text", "main_text"]
