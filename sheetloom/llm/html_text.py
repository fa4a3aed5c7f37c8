"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

Every block node of a page is described by its tag, attribute words, depth, place among
its siblings and the text density of its subtree (``dom.features``).  Gradient-boosted
trees give the probability that a node holds main text.  The decoding then chooses keep or
drop for all nodes at once: the likeliest assignment in which nothing is kept below a
dropped node, found by one pass up and one down the tree.

The classifier is trained here, on ``TRAIN_PAGES`` generated pages whose parts are known
(articles within every kind of frame or none, menus, notices, adverts, comments and forms,
in blocks or as loose text); no given page is looked at.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.dom import Node, features, read

TRAIN_PAGES = 800
TREES = 60
DEPTH = 4
BINS = 32
RATE = 0.25


# --- generated pages --------------------------------------------------------------

def _words(rng: random.Random, low: int, high: int) -> str:
    letters = rng.choice(["etaoinshrdlu", "enisratdhulcg", "eaosrnidlct", "esaitnrulodc"])
    n = rng.randint(low, high)
    words = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)]
    text = ""
    for w in words:
        text += w + rng.choices([" ", ", ", ". ", "? "], [12, 1.5, 1.2, 0.1])[0]
    return text.strip().capitalize() + "."


def _links(rng: random.Random, tag: str, attrs: str) -> str:
    items = [f'<a href="/{i}">{_words(rng, 1, 3).rstrip(".")}</a>' for i in range(rng.randint(3, 12))]
    form = rng.choice(["<ul>{}</ul>", "<ol>{}</ol>", "{}"])
    body = "".join(f"<li>{x}</li>" for x in items) if form != "{}" else " | ".join(items)
    return f"<{tag}{attrs}>{form.format(body)}</{tag}>"


def _around(rng: random.Random) -> str:
    """A part that is not main text."""
    kind = rng.choice("nav header footer aside ad notice comments form related share crumbs plain hidden".split())
    div = rng.choice(["div", "section", "div"])
    long = lambda: "".join(f"<p>{_words(rng, 6, 60)}</p>" for _ in range(rng.randint(1, 5)))
    some = lambda: rng.choice([_words(rng, 3, 25), long()])
    mark = lambda *names: f' {rng.choice(["class", "id", "class"])}="{rng.choice(names)}"'
    if kind == "nav":
        return _links(rng, rng.choice(["nav", "div", "nav", "menu"]), mark("nav", "main-menu", "navbar", "site-nav menu"))
    if kind == "header":
        return f"<header{mark('site-header', 'header', 'banner')}>{rng.choice(['', '<h1>%s</h1>' % _words(rng, 1, 4)])}{_words(rng, 2, 9)}</header>"
    if kind == "footer":
        return f"<{(t := rng.choice(['footer', 'div', 'footer']))}{mark('footer', 'site-footer', 'page-footer')}>&copy; {some()}</{t}>"
    if kind == "aside":
        return f"<{(t := rng.choice(['aside', 'div', 'aside']))}{mark('sidebar', 'side', 'widget-area sidebar')}>{rng.choice([some(), _links(rng, 'div', '')])}</{t}>"
    if kind == "ad":
        return f"<{div}{mark('ad', 'ads', 'advert', 'sponsor', 'promo-box', 'banner-ad')}>{some()}</{div}>"
    if kind == "notice":
        return f"<{div}{mark('cookie', 'cookie-notice', 'notice', 'consent-banner', 'alert', 'popup')}>{some()}</{div}>"
    if kind == "comments":
        one = lambda: f"<{rng.choice(['div', 'article', 'li'])}{mark('comment', 'reply', 'comment-body')}><p>{_words(rng, 5, 70)}</p>"
        return f"<{div}{mark('comments', 'comment-list', 'discussion comments')}><h3>{_words(rng, 1, 2)}</h3>" + "".join(
            one() for _ in range(rng.randint(1, 6))) + f"</{div}>"
    if kind == "form":
        return f"<form{mark('search', 'newsletter', 'login')}><p>{_words(rng, 3, 15)}</p><input><button>{_words(rng, 1, 2)}</button></form>"
    if kind == "related":
        return _links(rng, div, mark("related", "recommended", "related-posts", "read-more related"))
    if kind == "share":
        return _links(rng, div, mark("share", "social", "share-buttons"))
    if kind == "crumbs":
        return _links(rng, rng.choice(["div", "p", "nav"]), mark("breadcrumb", "breadcrumbs", "pagination"))
    if kind == "hidden":
        return f'<{div}{rng.choice([" hidden", " style=\"display:none\"", " aria-hidden=\"true\""])}>{some()}</{div}>'
    return _links(rng, div, "")


_MAIN = "data-main"
_LOOSE = "\ue000"         # begins a loose run of main text


def _inline(rng: random.Random, text: str) -> str:
    """``text`` in markup that makes no block, or bare."""
    tag = rng.choice(["", "", "center", "font", "span", "app-article", "x-content", "b"])
    return f"<{tag}>{text}</{tag}>" if tag else text


def _loose_article(rng: random.Random) -> str:
    """Main text that stands in the body itself: runs parted by <br>, between headings and paragraphs."""
    def run() -> str:
        parts = [_words(rng, *rng.choice([(10, 60), (40, 150)])) for _ in range(rng.choice([1, 1, 2, 4, 8]))]
        text = rng.choice(["<br>", "<br><br>", "<br/>\n"]).join(parts)
        if rng.random() < 0.15:
            text += f' <a href="/x">{_words(rng, 1, 4)}</a> {_words(rng, 3, 20)}'
        return _inline(rng, _LOOSE + text)

    head = rng.choice([f"<h1 {_MAIN}>{_words(rng, 3, 12)}</h1>"] * 3 + [""])
    parts = [run()]
    for _ in range(rng.choice([0, 0, 1, 2, 4])):
        parts += [rng.choice([f"<p {_MAIN}>{_words(rng, 10, 90)}</p>", f"<h2 {_MAIN}>{_words(rng, 2, 8)}</h2>",
                              f"<p {_MAIN}>{_words(rng, 10, 90)}</p>", _around(rng)])]
        parts += [run()] if rng.random() < 0.7 else []
    return head + "".join(parts)


def _loose_around(rng: random.Random) -> str:
    """Loose text that is not main text, closed off by a rule-like block."""
    links = lambda: rng.choice([" | ", " ", " - "]).join(
        f'<a href="/{i}">{_words(rng, 1, 3).rstrip(".")}</a>' for i in range(rng.randint(2, 10)))
    return _inline(rng, rng.choice([links(), links(), f"&copy; {_words(rng, 2, 8)}", _words(rng, 1, 5).rstrip(".")]))


def _article(rng: random.Random) -> str:
    """Main text; its blocks carry a mark that the reader turns into labels."""
    def block() -> str:
        text = _words(rng, *rng.choice([(2, 12), (10, 60), (40, 150)]))
        if rng.random() < 0.15:
            text = f'{text} <a href="/x">{_words(rng, 1, 4)}</a> {_words(rng, 3, 20)}'
        kind = rng.choices(["p", "h2", "ul", "blockquote", "table", "pre", "bold", "div"], [12, 2, 1, 1, 0.7, 0.4, 1, 0.7])[0]
        if kind == "ul":
            return f"<ul {_MAIN}>" + "".join(f"<li {_MAIN}>{_words(rng, 2, 20)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if kind == "table":
            return f"<table {_MAIN}><tr {_MAIN}>" + "".join(f"<td {_MAIN}>{_words(rng, 1, 5)}</td>" for _ in range(3)) + "</tr></table>"
        if kind == "bold":
            return f"<p {_MAIN}><b>{text}<br>"
        return f"<{kind} {_MAIN}>{text}" + (f"</{kind}>" if kind != "p" or rng.random() < 0.9 else "")

    tag = rng.choices(["article", "main", "div", "section"], [6, 2, 3, 1])[0]
    mark = rng.choice(["", ' class="post"', ' class="content"', ' id="main-content"', ' class="entry-content"',
                       ' class="article-body"', ' id="story"'])
    if tag in ("div", "section") and not mark:
        mark = ' class="content"'
    head = rng.choice([f"<h1 {_MAIN}>{_words(rng, 3, 12)}</h1>"] * 4 + [""])
    blocks = [block() for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 14]) + (not head))]
    inside = list(blocks)
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        inside.insert(rng.randint(0, len(inside)), _around(rng))
    body = head + "".join(inside)
    for _ in range(rng.choice([0, 0, 1])):
        body = f"<div {_MAIN}{rng.choice(['', ' class=\"wrap\"', ' class=\"body\"'])}>{body}</div>"
    return f"<{tag} {_MAIN}{mark}>{body}</{tag}>"


def generated_page(rng: random.Random) -> tuple[list[Node], np.ndarray]:
    """A page's nodes and, for each, whether it is (or leads to) main text."""
    before = [_around(rng) for _ in range(rng.randint(0, 4))]
    after = [_around(rng) for _ in range(rng.randint(0, 4))]
    loose = rng.random() < 0.3
    article = (_loose_article if loose else _article)(rng) if rng.random() > 0.04 else ""
    # a block parts the loose texts around from the article's own
    if rng.random() < 0.3:
        before = [_loose_around(rng), *before, _links(rng, "nav", "")]
    if rng.random() < 0.3:
        after = [_links(rng, "footer", ""), *after, _loose_around(rng)]
    inner = "".join(before) + article + "".join(after)
    if loose:
        page = rng.choice([f"<!DOCTYPE html><html><head><title>x</title></head><body>{inner}</body></html>",
                           f"<html><body>{inner}", inner])
        return _labelled(page)
    for _ in range(rng.choice([0, 0, 1, 2])):
        inner = f'<div{rng.choice(["", " class=\"wrapper\"", " id=\"page\"", " class=\"container\"", " class=\"layout row\""])}>{inner}</div>'
    return _labelled(f"<!DOCTYPE html><html><head><title>x</title></head><body>{inner}</body></html>")


def _labelled(page: str) -> tuple[list[Node], np.ndarray]:
    marks = read(page.replace(_MAIN, 'role="mainmark"'))
    kept = np.array(["mainmark" in x.words or any(_LOOSE in t for _, t in x.pieces) for x in marks])
    for i in range(len(marks) - 1, 0, -1):
        kept[marks[i].parent] |= kept[i]
    for x in marks:
        x.words = x.words - {"mainmark"}
        x.pieces = [(at, t.replace(_LOOSE, "")) for at, t in x.pieces]
    return marks, kept


# --- boosted trees ----------------------------------------------------------------

class BoostedTrees:
    """Logistic gradient boosting of regression trees on binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = self._binned(x)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(mean / (1 - mean))), []
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += RATE * self._walk(tree, binned)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], axis=1)

    @staticmethod
    def _grow(binned, gradient, hessian):
        """A tree of full depth as (feature, bin) per inner node and values per leaf."""
        inner, place = [], np.zeros(len(binned), dtype=np.int64)
        for level in range(DEPTH):
            for node in range(1 << level):
                rows = np.flatnonzero(place == node)
                best, choice = 1e-9, (0, BINS)          # (0, BINS): everything goes left
                if len(rows) >= 20:
                    g, h = gradient[rows], hessian[rows]
                    whole = g.sum() ** 2 / (h.sum() + 1)
                    for f in range(binned.shape[1]):
                        b = binned[rows, f]
                        gs = np.cumsum(np.bincount(b, g, BINS + 1))[:-1]
                        hs = np.cumsum(np.bincount(b, h, BINS + 1))[:-1]
                        gain = gs ** 2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
                        k = int(gain.argmax())
                        if gain[k] > best:
                            best, choice = gain[k], (f, k)
                inner.append(choice)
            at = np.array(inner[(1 << level) - 1:])
            place = 2 * place + (binned[np.arange(len(binned)), at[place, 0]] > at[place, 1])
        g = np.bincount(place, gradient, 1 << DEPTH)
        h = np.bincount(place, hessian, 1 << DEPTH)
        return np.array(inner), g / (h + 1)

    @staticmethod
    def _walk(tree, binned):
        inner, values = tree
        place, rows = np.zeros(len(binned), dtype=np.int64), np.arange(len(binned))
        for level in range(DEPTH):
            at = (1 << level) - 1 + place
            place = 2 * place + (binned[rows, inner[at, 0]] > inner[at, 1])
        return values[place]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.base + RATE * sum(self._walk(t, binned) for t in self.trees)


@lru_cache(maxsize=1)
def model(pages: int = TRAIN_PAGES, seed: int = 11) -> BoostedTrees:
    rng = random.Random(seed)
    made = [generated_page(rng) for _ in range(pages)]
    return BoostedTrees().fit(np.concatenate([features(n) for n, _ in made]), np.concatenate([k for _, k in made]))


# --- decoding ---------------------------------------------------------------------

def decode(nodes: list[Node], log_odds: np.ndarray) -> list[bool]:
    """Keep or drop for each node: the likeliest choice with nothing kept below a dropped
    node.  The page itself is kept."""
    odds = np.clip(log_odds, -30, 30)
    keep = -np.logaddexp(0, -odds)          # log-probabilities
    drop = -np.logaddexp(0, odds)
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        p = nodes[i].parent
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [True] * len(nodes)
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and bool(keep[i] > drop[i])
    return kept


def main_texts(pages: list[str | None], trees: BoostedTrees) -> list[str]:
    """The main text of each page."""
    read_pages = [read(p) for p in pages]
    if not read_pages:
        return []
    odds = trees.log_odds(np.concatenate([features(n) for n in read_pages]))
    out, at = [], 0
    for nodes in read_pages:
        kept = decode(nodes, odds[at:at + len(nodes)])
        at += len(nodes)
        if all(x.tag in ("#page", "#text") for x in nodes):     # no element: a text is its own main text
            kept = [True] * len(nodes)
        blocks = sorted(b for x, k in zip(nodes, kept) if k and x.tag != "head" for b in x.pieces)
        out.append("\n\n".join(t for _, t in blocks))
    return out


def extracted(pages: DataFrame, trees: BoostedTrees | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``page_id, url, html``.

    The text is the article's blocks in page order, parted by two line ends; empty if the
    page has none (or is null or empty).  A text without any element is its own main text.
    Rows are read one by one: repeated rows, ties and null ids or urls make no difference;
    other columns are ignored.
    """
    fitted = trees or model()

    @F.pandas_udf("string")
    def text(source: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(source), 200):
            out += main_texts(list(source.iloc[at:at + 200]), fitted)
        return pd.Series(out, dtype="object")

    return pages.select("page_id", "url", text("html").alias("text")).select(
        "*", F.length("text").cast("long").alias("n_chars"))
