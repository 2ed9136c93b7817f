"""Small helpers for one page: blocks with their places in a folded element tree, and simple tree matching of two trees."""

from __future__ import annotations

import hashlib
import html
import re

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^<>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# What HTML's elements are; fixed values of the format.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}
# Siblings of these kinds are instances of one node, as rows of a list are.
REPEATED = {"p", "li", "tr", "td", "th", "dt", "dd", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "head", "button", "select", "svg", "canvas", "object", "dialog", "search", "fieldset"}
CONTENT = {"article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"}
WORDS = {
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "commentlist", "comments", "consent", "cookie", "cookies", "discussion", "disqus", "footer",
    "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply",
    "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar",
    "widget", "widgets",
}
# Words that add nothing to a furniture word's meaning: a name of these and at least one of WORDS is furniture anywhere.
NEUTRAL = {
    "area", "articles", "bar", "block", "bottom", "box", "container", "global", "inner", "item", "items", "left", "link", "links",
    "list", "outer", "posts", "right", "row", "site", "thread", "top", "wrap", "wrapper",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# The container of a page's text is the lowest element that holds this share of it.
CONTAINS = 0.8


class Page:
    """A page's blocks (node, text) and its tree (label, parent)."""

    def __init__(self, source: str):
        self.labels: list[str] = [""]
        self.parents: list[int] = [-1]
        self.children: list[dict[str, int]] = [{}]
        self.blocks: list[tuple[int, str]] = []
        # Of each block whether a name hints at furniture, and whether it is inside content.
        self.hints: list[tuple[bool, bool]] = []
        # Open elements: tag, node of the innermost block, whether left out, whether inside content, whether hinted at.
        self.stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
        self.buffer: list[str] = []
        self._read(source)

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                _, node, _, inside, hinted = self.stack[-1]
                self.blocks.append((node, text))
                self.hints.append((hinted, inside))
            self.buffer = []

    def _node(self, parent: int, tag: str, names: str) -> int:
        label = f"{tag}.{names}" if names else tag
        own = self.children[parent]
        if tag in REPEATED or names:
            known = own.get(label)
            if known is not None:
                return known
            key = label
        else:  # plain containers stay apart, the ones after many share a node
            n = sum(1 for k in own if k.split("#")[0] == label)
            key = label if not n else f"{label}#{min(n, 8)}"
            if key in own:
                return own[key]
        own[key] = len(self.labels)
        self.labels.append(label)
        self.parents.append(parent)
        self.children.append({})
        return own[key]

    def _close_to(self, depth: int) -> None:
        self._flush()
        del self.stack[depth:]

    def _open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCK
        if block:
            self._flush()
            for i in range(len(self.stack) - 1, 0, -1):  # a block ends an open paragraph
                open_tag = self.stack[i][0]
                if open_tag == "p":
                    del self.stack[i:]
                    break
                if open_tag in BLOCK:
                    break
            if tag in CLOSES:
                ends, scope = CLOSES[tag]
                for i in range(len(self.stack) - 1, 0, -1):
                    open_tag = self.stack[i][0]
                    if open_tag in ends:
                        del self.stack[i:]
                        if tag != "tr" or open_tag == "tr":
                            break
                    elif open_tag in scope:
                        break
        names, left_out, content, hinted = "", False, tag in CONTENT, False
        _, node, outside, inside, above = self.stack[-1]
        if attributes and not attributes.isspace():
            for kind, a, b, c in ATTRIBUTE.findall(attributes):
                kind, value = kind.lower(), a or b or c
                if kind == "hidden":
                    left_out = True
                elif kind == "role":
                    left_out |= value.lower() in ROLES
                    content |= value.lower() == "main"
                elif kind == "itemprop":
                    content |= value.lower() == "articlebody"
                else:
                    if tag not in ("html", "body") and tag not in CONTENT:
                        for name in value.split():
                            words = {w.lower() for w in PARTS.findall(name)}
                            marks = words & WORDS
                            if inside and words == {"header"}:  # an article's own
                                continue
                            hinted |= block and bool(marks)
                            left_out |= bool(marks) and words <= WORDS | NEUTRAL
                    if kind == "class":
                        names = re.sub(r"[0-9]+", "0", " ".join(sorted(value.split())))
        if tag in FURNITURE or tag == "header" and not inside:
            left_out = True
        if tag in VOID:
            return
        if block:
            node = self._node(node, tag, names)
        self.stack.append((tag, node, outside or left_out, inside or content, above or hinted))

    def _read(self, source: str) -> None:
        at, stack = 0, self.stack
        match = TOKEN.search(source)
        while match:
            if match.start() > at and not stack[-1][2]:
                self._text(source[at : match.start()])
            at = match.end()
            tag = match.group(2) or match.group(5)
            if tag:
                tag = tag.lower()
                closing = match.group(1) or match.group(4)
                if closing:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == tag:
                            if tag in BLOCK:
                                self._close_to(i)
                            else:
                                del stack[i:]
                            break
                        if stack[i][0] in BLOCK and tag not in BLOCK:
                            break
                elif tag in RAW:
                    end = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                    if not end:
                        at = len(source)
                        break
                    at = source.find(">", end.start()) + 1 or len(source)
                else:
                    self._open(tag, match.group(3) or match.group(6) or "")
                    if tag == "br" and self.buffer:
                        self.buffer.append(" ")
            match = TOKEN.search(source, at)
        if at < len(source) and not stack[-1][2]:
            self._text(source[at:])
        self._flush()

    def _text(self, raw: str) -> None:
        self.buffer.append(html.unescape(raw) if "&" in raw else raw)

    def _container(self) -> int:
        """The lowest element, no paragraph or row of a list, that holds `CONTAINS` of the text no name hints at; an `article`
        or `main` around it goes before it."""
        sizes = [0] * len(self.labels)
        for (node, text), (hinted, inside) in zip(self.blocks, self.hints, strict=True):
            if inside or not hinted:
                sizes[node] += len(text)
        for i in range(len(sizes) - 1, 0, -1):
            sizes[self.parents[i]] += sizes[i]
        node, down = 0, True
        while down:
            down = False
            for x in self.children[node].values():
                if sizes[x] and sizes[x] >= CONTAINS * sizes[0] and self._tag(x) not in REPEATED:
                    node, down = x, True
                    break
        at = node
        while at > 0:
            if self._tag(at) in CONTENT:
                node = at
            at = self.parents[at]
        return node

    def _tag(self, node: int) -> str:
        return self.labels[node].partition(".")[0]

    def content(self) -> list[tuple[int, str]]:
        """All blocks that are no furniture, in page order: (node, text).

        Elements, roles and names that say nothing else are furniture anywhere. A name that only holds such a word
        (`section-header`, `related-work`) counts outside the container of the page's text, inside it says nothing.
        """
        if not any(hinted for hinted, _ in self.hints):
            return self.blocks
        within = [False] * len(self.labels)
        within[self._container()] = True
        for i in range(1, len(within)):
            within[i] |= within[self.parents[i]]
        return [b for b, (hinted, _) in zip(self.blocks, self.hints, strict=True) if within[b[0]] or not hinted]

    def leads(self, blocks: list[tuple[int, str]]) -> list[int]:
        """For each heading the place of the next block that is none, if both stand in one element; else -1."""
        out, following = [-1] * len(blocks), -1
        for i in range(len(blocks) - 1, -1, -1):
            node = blocks[i][0]
            if self._tag(node) not in HEADINGS:
                following = i
            elif following >= 0 and self.parents[node] == self.parents[blocks[following][0]]:
                out[i] = following
        return out

    def skeleton(self) -> str:
        """The tree as text: each node's parent and label."""
        return "\n".join(f"{p} {x}" for p, x in zip(self.parents, self.labels, strict=True))


def read_skeleton(text: str) -> tuple[list[str], list[list[int]]]:
    labels, children = [], []
    for i, line in enumerate(text.split("\n")):
        parent, _, label = line.partition(" ")
        labels.append(label)
        children.append([])
        if int(parent) >= 0:
            children[int(parent)].append(i)
    return labels, children


def align(own: str, reference: str, by_tag: bool = False) -> dict[int, int]:
    """Simple tree matching: the largest order-keeping, parent-keeping match of nodes with equal labels, as own -> reference.

    With `by_tag` nodes match whose tags are equal, and equal class names only count for more.
    """
    (la, ca), (lb, cb) = read_skeleton(own), read_skeleton(reference)
    sizes: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}
    ta, tb = ([x.partition(".")[0] for x in labels] if by_tag else labels for labels in (la, lb))
    # Only nodes with equal labels all the way from the root can be matched: their paths get equal numbers.
    ids: dict[tuple[int, str], int] = {}
    ka, kb = [0] * len(la), [0] * len(lb)
    for labels, children, keys in ((ta, ca, ka), (tb, cb, kb)):
        keys[0] = ids.setdefault((-1, labels[0]), len(ids))
        for i, below in enumerate(children):
            for x in below:
                keys[x] = ids.setdefault((keys[i], labels[x]), len(ids))
    others: dict[int, list[int]] = {}
    for b in range(len(lb) - 1, -1, -1):
        others.setdefault(kb[b], []).append(b)

    # Children have larger numbers than their parents, so pairs can be met from the last to the first.
    for a in range(len(la) - 1, -1, -1):
        for b in others.get(ka[a], ()):
            table = [[0] * (len(cb[b]) + 1) for _ in range(len(ca[a]) + 1)]
            for i, x in enumerate(ca[a], 1):
                for j, y in enumerate(cb[b], 1):
                    table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + sizes.get((x, y), 0))
            sizes[a, b] = 1 + (by_tag and la[a] == lb[b]) + table[-1][-1]
            tables[a, b] = table
    found, todo = {}, [(0, 0)] if (0, 0) in sizes else []
    while todo:
        a, b = todo.pop()
        found[a] = b
        table, i, j = tables[a, b], len(ca[a]), len(cb[b])
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((ca[a][i], cb[b][j]))
    return found


def slots(own: str, reference: str, by_tag: bool = False) -> list[int]:
    """Per node a number that aligned nodes of a host's trees share: the reference's node, or a negative hash of the way
    down from the nearest aligned node if there is none."""
    found = align(own, reference, by_tag)
    labels, children = read_skeleton(own)
    out = [0] * len(labels)
    if 0 not in found:
        out[0] = -1
    for i, below in enumerate(children):
        seen: dict[str, int] = {}
        for x in below:
            if x in found:
                out[x] = found[x]
                continue
            label = labels[x].partition(".")[0] if by_tag else labels[x]
            seen[label] = seen.get(label, 0) + 1
            digest = hashlib.blake2b(f"{out[i]} {seen[label]} {label}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
            out[x] = -2 - (int.from_bytes(digest, "little") >> 2)
    return out
