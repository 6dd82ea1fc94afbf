"""HTML extraction by tree scoring.

Method. A page is read into a tree as a lenient browser would: implied ends of paragraphs, list items and
table cells, unmatched end tags ignored, open elements closed at the end. Elements that are no content
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments: by tag,
role, hidden state, or a word of class or id) are cut out. Each paragraph passes points to its parent, one
for itself, one for every comma and one for every 100 code points, and each container passes half of its
points on; points are discounted by link density (share of code points inside links). The best container
wins, ties to the outermost; inside an article or main element that element is taken whole. Siblings are
kept too: paragraphs, headings and what has a fifth of its points; beside an article element, articles of
the same attributes with that many points. Inside, lists and boxes made of links are dropped.

text: the blocks in page order, character references decoded, white space of any kind as one space,
trimmed, joined by one space. Nothing else is dropped or capped.

One pass over the html and two over the nodes, linear in the page whatever its nesting; a projection
without shuffle. Rows arrive in batches, one page is worked on at a time.

Edge cases: null or empty html, and pages without text, give the empty text; html that is cut off ends
there; plain text without tags is one paragraph; every row gives a row, repeated rows included; an empty
table gives none; other columns are not read.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------
# Tag names of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: A start of one of these ends an open paragraph; their bounds part blocks.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Which open elements a start tag ends, up to the nearest element of the second set.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tbody": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
}
#: Never content.
CUT_TAGS = frozenset(
    "script style template head title noscript nav footer aside form button select option datalist textarea input label iframe object embed "
    "applet svg canvas audio video map menu dialog noembed noframes xmp search".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
#: Words of class and id names.
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promoted promotion banner banners "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toc sidebar sidebars aside rail footer foot masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications popup popups modal overlay lightbox alert disclaimer paywall "
    "newsletter subscribe subscription signup signin login register share sharing sharebar social follow related recommended recommendations teaser teasers outbrain taboola "
    "comment comments commentlist disqus respond reply replies discussion widget widgets search searchbox skip hidden".split()
)
CUT_ENDINGS = ("nav", "navbar", "menu", "sidebar", "footer", "banner")
#: Words of a header that is the page's, not an article's.
PAGE_WORDS = frozenset("site page global main top".split())
#: A name that says what stands beside the element, not what it is.
BESIDE = frozenset("has with no without is js".split())
# ---- end of fixed values --------------------------------------------------------------------

PARTS = re.compile(r"<!--|<!|<\?|<(/?)([a-zA-Z][^\s/>]*)")
SIMPLE = re.compile(r"[^>\"']*>")
STOP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
COMMA = re.compile("[,،、，;；]")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "attributes", "points", "size", "linked", "holds_article", "paragraphs", "links", "boxed", "words")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.children: list[Node | str] = []
        self.cut = self.holds_article = self.boxed = False
        self.points = 0.0
        self.size = self.linked = self.links = self.paragraphs = 0
        #: words of its class and id, lower-cased
        self.words: set[str] = set()


def tag_end(html: str, at: int, none_left: dict[str, int]) -> int:
    """Place behind a tag's closing sign; quoted values may hold one. Without a closing quote the first
    sign counts; without any sign the page ends inside the tag."""
    first = html.find(">", at)
    simple = SIMPLE.match(html, at)
    if simple:
        return simple.end()
    here = at
    while stop := STOP.search(html, here):
        quote = stop.group(1)
        if quote is None:
            return stop.end()
        close = -1 if stop.end() > none_left.get(quote, len(html)) else html.find(quote, stop.end())
        if close < 0:
            none_left[quote] = min(none_left.get(quote, len(html)), stop.end())
            return first + 1 if first >= 0 else len(html)
        here = close + 1
    return len(html)


def parse(html: str) -> list[Node]:
    """The page's root and all its elements in page order."""
    root = Node("#root", None)
    nodes, stack, at, n = [root], [root], 0, len(html)
    open_tags: dict[str, int] = {}
    none_left: dict[str, int] = {}
    last_sign = html.rfind(">")

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            open_tags[stack.pop().tag] -= 1

    def nearest(names, barrier) -> int:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                return depth
            if stack[depth].tag in barrier:
                return 0
        return 0

    while at < n:
        found = PARTS.search(html, at)
        if not found or found.start() > last_sign:
            # what follows is text, up to a tag or comment that the page's end cuts off
            stack[-1].children.append(unescape(html[at : found.start() if found else n]))
            break
        if found.start() > at:
            stack[-1].children.append(unescape(html[at : found.start()]))
        begin = found.start()
        name = found.group(2)
        if name is None:
            end = html.find("-->", begin + 4) if html.startswith("<!--", begin) else html.find(">", begin)
            at = n if end < 0 else end + (3 if html.startswith("<!--", begin) else 1)
            continue
        end = tag_end(html, found.end(), none_left)
        name, attributes = name.lower(), html[found.end() : end - 1]
        at = end
        if found.group(1):
            if open_tags.get(name):
                depth = nearest((name,), ())
                # an end of inline markup never closes blocks that began inside it
                if name in BLOCKS or name in CUT_TAGS or not any(x.tag in BLOCKS for x in stack[depth + 1 :]):
                    close_to(depth)
            elif name in ("p", "br"):
                stack[-1].children.append(" ")
            continue
        if open_tags.get("head") and name not in ("meta", "title", "link", "script", "style", "base", "noscript", "template"):
            close_to(nearest(("head",), ()))
        if name in ("html", "body") and open_tags.get(name):
            continue
        if name in BLOCKS and open_tags.get("p"):
            depth = nearest(("p",), ("td", "th", "table", "caption", "button", "object"))
            if depth:
                close_to(depth)
        if name in ENDS:
            ends, barrier = ENDS[name]
            while any(open_tags.get(x) for x in ends) and (depth := nearest(ends, barrier)):
                close_to(depth)
        elif name in HEADINGS and stack[-1].tag in HEADINGS:
            close_to(len(stack) - 1)
        node = Node(name, stack[-1], attributes)
        stack[-1].children.append(node)
        nodes.append(node)
        if name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, at)
            if close is None:
                at = n
            else:
                at = tag_end(html, close.end(), none_left)
        elif name not in VOID and attributes != "/" and not attributes.endswith((" /", '"/')):
            # an element written with a closing slash is taken as empty
            stack.append(node)
            open_tags[name] = open_tags.get(name, 0) + 1
    return nodes


def attributes_of(node: Node) -> dict[str, str]:
    return {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(node.attributes)}


def is_clutter(node: Node) -> bool:
    """By tag, role, hidden state, or a word of class or id."""
    if node.tag in CUT_TAGS:
        return True
    if not node.attributes or node.tag in ("html", "body", "#root"):
        return False
    has = attributes_of(node)
    for name in f"{has.get('class', '')} {has.get('id', '')}".split():
        words = [w.lower() for w in NAME_PART.findall(name)]
        if words and words[0] not in BESIDE:
            node.words.update(words)
    style = has.get("style", "").replace(" ", "").lower()
    if "hidden" in has or has.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    return has.get("role", "").lower() in CUT_ROLES or not CUT_WORDS.isdisjoint(node.words) or any(w.endswith(CUT_ENDINGS) for w in node.words)


def is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or 'role="main"' in node.attributes or "articlebody" in node.attributes.lower()


def prune(nodes: list[Node]) -> None:
    """Mark what is cut. A header of an article keeps its headings; an element around the article, or a
    form around most paragraphs of the page, stays whatever it is called."""
    clutter = [is_clutter(x) for x in nodes]
    for node, bad in zip(reversed(nodes), reversed(clutter)):
        node.paragraphs += node.tag == "p"
        if node.parent:
            node.parent.paragraphs += node.paragraphs
            node.parent.holds_article |= node.holds_article or is_article(node) and not bad
    within = {id(nodes[0]): False}
    for node, bad in zip(nodes[1:], clutter[1:]):
        above = node.parent
        inner = within[id(node)] = within[id(above)] or is_article(above)
        if above.cut:
            node.cut = True
        elif node.tag == "form":
            node.cut = not node.holds_article and 2 * node.paragraphs <= nodes[0].paragraphs
        elif bad:
            node.cut = node.tag in CUT_TAGS or not node.holds_article
        elif node.tag == "header" or node.tag in ("div", "section") and "header" in node.words:
            of_page = not inner and (above.tag in ("#root", "html", "body") or not PAGE_WORDS.isdisjoint(node.words))
            node.cut = of_page and not node.holds_article
            if not of_page:
                node.children = [c for c in node.children if isinstance(c, Node) and holds_heading(c)]


def holds_heading(node: Node) -> bool:
    todo = [node]
    while todo:
        x = todo.pop()
        if x.tag in HEADINGS:
            return True
        todo += [c for c in x.children if isinstance(c, Node) and c.tag in ("div", "hgroup", "a", "span")]
    return False


def score(nodes: list[Node]) -> None:
    """Points, code points and linked code points of every element, from the last to the first."""
    for node in reversed(nodes):
        if node.cut:
            continue
        own = 0
        for child in node.children:
            if isinstance(child, str):
                kept = " ".join(child.split())
                own += len(kept)
                node.points += len(COMMA.findall(kept))
        node.size += own
        if node.tag == "a":
            node.linked, node.links = node.size, node.links + 1
        light = 1 - node.linked / node.size if node.size else 0.0
        if node.tag not in BLOCKS:
            passed = node.points  # inline markup: to the paragraph that it stands in
        elif node.boxed:
            node.points = (node.points + (own > 0) + own / 100) * light
            passed = node.points / 2
        else:
            node.points = (node.points + 1 + node.size / 100) * light
            passed = node.points
        if node.parent:
            node.parent.points += passed
            node.parent.size += node.size
            node.parent.linked += node.linked
            node.parent.links += node.links
            node.parent.boxed |= node.boxed or node.tag in BLOCKS


def best_container(nodes: list[Node]) -> Node:
    """The element of most points that holds blocks; the whole page, if none does."""
    boxes = [x for x in nodes[1:] if x.boxed and not x.cut and x.size and x.tag in BLOCKS and x.tag not in ("html", "tr")]
    best = max(boxes, key=lambda x: x.points, default=nodes[0])
    around, outer = best, None
    while around is not None:
        if is_article(around) and (outer is None or outer.tag != "article"):
            outer = around
        around = around.parent
    return outer or best


def is_menu(node: Node) -> bool:
    """A list or box that is nearly all links."""
    return node.tag in ("ul", "ol", "dl", "div", "section", "table") and node.links >= 3 and node.linked >= 0.8 * node.size


def kept_siblings(best: Node) -> list[Node]:
    """The best container and, in page order, the siblings that belong to it."""
    if best.parent is None:
        return [best]
    out = []
    for node in best.parent.children:
        if node is best:
            out.append(node)
        elif isinstance(node, Node) and not node.cut and node.size and node.linked <= 0.25 * node.size:
            strong = node.tag in BLOCKS and node.points >= max(best.points / 5, 1)
            if is_article(best):
                belongs = strong and node.tag == best.tag and node.attributes == best.attributes
            else:
                belongs = strong or node.tag in HEADINGS or node.tag == "p"
            if belongs:
                out.append(node)
    return out


def text_of(tops: list[Node]) -> str:
    pieces: list[str] = []
    todo: list[Node | str] = list(reversed(tops))
    chosen = {id(x) for x in tops}
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            pieces.append(x)
        elif not x.cut and (id(x) in chosen or not is_menu(x)):
            if x.tag in BLOCKS or x.tag == "br":
                pieces.append(" ")
                todo.append(" ")
            todo += reversed(x.children)
    return " ".join("".join(pieces).split())


def extract(html: str | None) -> tuple[str, str, float]:
    """Main text, the tag of the container that it was found in, and its points."""
    if not html:
        return "", "", 0.0
    nodes = parse(html)
    prune(nodes)
    score(nodes)
    best = best_container(nodes)
    return text_of(kept_siblings(best)), best.tag, best.points


def _extracted(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [extract(x.as_py()) for x in batch.column(keys)]
        text, container, points = zip(*rows) if rows else ((), (), ())
        found = [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(container, pa.string()), pa.array(points, pa.float64())]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(keys)] + found, names=[f"c{i}" for i in range(keys + 4)])


def main_text(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """Per page: the key columns, text, n_chars (code points), container (its tag) and points."""
    rows = pages.select(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keys)], F.col(html).alias("html"))
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema[:-1])]
    n = len(keys)
    kinds += [f"c{n} string", f"c{n + 1} long", f"c{n + 2} string", f"c{n + 3} double"]
    out = rows.mapInArrow(lambda it: _extracted(it, n), ", ".join(kinds))
    return out.toDF(*keys, "text", "n_chars", "container", "points")
