"""A tolerant reader of HTML into block nodes, as features for a classifier.

Only block elements are nodes; inline markup stays within its block.  A run of text that
no block but the page or its body holds is a node ``#text`` of its own.  What is never text
(scripts, styles, comments, the head) is left out while reading.  Pages may end anywhere:
open elements are closed at the end, an unfinished tag there is dropped.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<end>>|\Z)", re.S)
_BROKEN = re.compile(r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)(?P<end>>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|style|aria-hidden|aria-label)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# Kinds of HTML elements.  What is left out ends at its closing tag; if that is missing, RAW runs to the
# end of the page (as in browsers) and SKIPPED to the end of its parent.
RAW = frozenset("script style textarea title".split())
SKIPPED = frozenset("template noscript svg math iframe object select option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body article main section div header footer nav aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table "
    "thead tbody tfoot tr td th caption blockquote pre figure figcaption details summary address fieldset dialog "
    "menu search hgroup head".split())
CLOSED_BY = {       # an open element (key) ends where one of these begins
    "p": BLOCK - {"html", "body", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "head": BLOCK - {"html", "head"},
}
HOLDERS = frozenset(["#page", "html", "body"])      # text directly in these is a node of its own
NEGATIVE = ("nav menu footer header sidebar side aside comment reply ad ads advert promo sponsor banner cookie consent "
            "notice popup modal share social related recommend newsletter subscribe breadcrumb pagination pager "
            "widget toolbar login search form copyright legal tags meta byline alert disclaimer hidden").split()
POSITIVE = "article content main body post entry story text page blog".split()
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: frozenset = frozenset()
    unseen: bool = False
    pieces: list = field(default_factory=list)      # (order, text) runs directly inside
    children: list = field(default_factory=list)
    links: int = 0                                  # characters of own text within links


def _tag(page: str, lt: int) -> re.Match | None:
    m = _TOKEN.match(page, lt)
    if m is None or (m["tag"] and m["end"] == ""):
        m = _BROKEN.match(page, lt) or m        # an unclosed quotation mark
    return m


def _after_skipped(page: str, at: int, tag: str, around: list[str], last: int) -> int:
    """Where reading goes on after a skipped element ``tag`` whose content begins at ``at``.

    That is behind its closing tag, or where the element around it ends: at the closing tag
    of that one (a block of ``around``, or inline markup opened before), or where a block
    begins that ends it.  ``last`` is the place of the page's last closing tag of this kind.
    """
    inside, implied = [tag], None
    while (lt := page.find("<", at)) >= 0:
        m = _tag(page, lt)
        at = m.end() if m else lt + 1
        if m is None or m["tag"] is None or m["end"] == "":
            continue
        name = m["tag"].lower()
        if m["close"]:
            if name in inside:
                while inside.pop() != name:
                    pass
                if not inside:
                    return at
            elif name in around or name not in BLOCK:
                return lt if implied is None else implied
        else:
            ends = name == tag == "option" or name in CLOSED_BY.get(around[-1], ()) and not BLOCK & set(inside)
            if implied is None and ends:
                implied = lt
            if implied is not None and (lt > last or tag == "option"):
                return implied
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            elif name not in VOID and not m["attrs"].endswith("/"):
                inside.append(name)
    return len(page) if implied is None else implied


def read(page: str | None) -> list[Node]:
    """The block nodes of a page in order; node 0 is the page itself."""
    nodes = [Node("#page", -1, 0)]
    stack = [0]
    run: list[str] = []
    state = {"order": 0, "links": 0, "linked": 0}
    page = page or ""
    last: dict[str, int] = {}

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        node = nodes[stack[-1]]
        if text:
            if node.tag in HOLDERS:
                node.children.append(len(nodes))
                node = Node("#text", stack[-1], len(stack))
                nodes.append(node)
            node.pieces.append((state["order"], text))
            state["order"] += 1
        node.links += state["linked"]
        state["linked"] = 0
        run.clear()

    def add(text: str) -> None:
        run.append(text)
        if state["links"]:
            state["linked"] += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        m = _tag(page, lt)
        if m is None:
            add("<")
            at = lt + 1
            continue
        at = m.end()
        if m["tag"] is None or m["end"] == "":
            continue
        tag = m["tag"].lower()
        if tag in RAW:
            if not m["close"] and not m["attrs"].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else size
            run.append(" ")
            continue
        if tag in SKIPPED:
            if not m["close"] and not m["attrs"].endswith("/"):
                if tag not in last:
                    last[tag] = max((c.start() for c in re.finditer(rf"</{re.escape(tag)}\b", page, re.I)), default=-1)
                at = _after_skipped(page, at, tag, [nodes[k].tag for k in stack], last[tag])
            run.append(" ")
            continue
        if tag not in BLOCK:
            if tag == "a":
                state["links"] = 0 if m["close"] else 1
            if tag in VOID:
                run.append(" ")
            continue
        flush()
        state["links"] = 0
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(nodes[stack[-1]].tag, ()):
            stack.pop()
        node = Node(tag, stack[-1], len(stack), *_attributes(m["attrs"]))
        nodes[stack[-1]].children.append(len(nodes))
        stack.append(len(nodes))
        nodes.append(node)
    flush()
    return nodes


def _attributes(attrs: str) -> tuple[frozenset, bool]:
    words, unseen = set(), False
    for name, a, b, c in _ATTR.findall(attrs):
        value = a or b or c
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or \
                name == "style" and "display:none" in value.replace(" ", "").lower():
            unseen = True
        elif name != "style":
            words.update(w for w in _SPLIT.split(value.lower()) if w)
    return frozenset(words), unseen


_TAGS = ["#page", "html", "body", "article", "main", "section", "div", "header", "footer", "nav", "aside", "form",
         "p", "ul", "ol", "li", "table", "tr", "td", "blockquote", "pre", "figure", "figcaption", "head", "#text"]
_CODE = {t: i for i, t in enumerate(_TAGS)}
FEATURES = ("tag heading own_chars own_link_share tree_chars tree_link_share density tree_nodes depth place places "
            "same_tag_share punctuation negative positive unseen above_negative above_positive in_article "
            "parent_tag children sibling_chars longest words_mean").split()


def _marked(words: frozenset, known: list[str]) -> int:
    return sum(1 for w in words if w in known or (len(w) > 4 and w.rstrip("s0123456789") in known))


def features(nodes: list[Node]) -> np.ndarray:
    """One row of FEATURES per node."""
    n = len(nodes)
    own = np.array([sum(len(t) for _, t in x.pieces) for x in nodes], dtype=np.float64)
    link = np.minimum(own, [x.links for x in nodes])
    tree, tree_link, count, longest = own.copy(), link.copy(), np.ones(n), own.copy()
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        tree[p] += tree[i]
        tree_link[p] += tree_link[i]
        count[p] += count[i]
        longest[p] = max(longest[p], longest[i])
    out = np.zeros((n, len(FEATURES)))
    minus, plus, article = np.zeros(n), np.zeros(n), np.zeros(n)
    places, alike = [0] * n, [1.0] * n
    for x in nodes:
        tags = Counter(nodes[c].tag for c in x.children)
        for place, c in enumerate(x.children):
            places[c], alike[c] = place, tags[nodes[c].tag] / len(x.children)
    for i, x in enumerate(nodes):
        text = " ".join(t for _, t in x.pieces)
        up = nodes[x.parent] if x.parent >= 0 else x
        neg, pos = _marked(x.words, NEGATIVE), _marked(x.words, POSITIVE)
        if x.parent >= 0:
            minus[i] = minus[x.parent] + (_marked(up.words, NEGATIVE) + (up.tag in ("nav", "footer", "aside", "form", "header")) > 0)
            plus[i] = plus[x.parent] + (_marked(up.words, POSITIVE) > 0)
            article[i] = article[x.parent] or up.tag in ("article", "main")
        out[i] = (
            _CODE.get(x.tag, len(_TAGS)), int(x.tag[1:]) if re.fullmatch("h[1-6]", x.tag) else 0, own[i],
            link[i] / own[i] if own[i] else 0.0, tree[i], tree_link[i] / tree[i] if tree[i] else 0.0,
            tree[i] / count[i], count[i], x.depth, places[i], len(up.children), alike[i],
            sum(map(text.count, ".,;:!?")) / (len(text) + 1) * 100, neg, pos, x.unseen, minus[i], plus[i], article[i],
            _CODE.get(up.tag, len(_TAGS)), len(x.children), tree[x.parent] - tree[i] if x.parent >= 0 else 0.0,
            longest[i], len(text) / (text.count(" ") + 1))
    return out
