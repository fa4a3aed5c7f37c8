import random

import numpy as np
import pytest

from sheetloom.llm.dom import FEATURES, features, read
from sheetloom.llm.html_text import decode, extracted, generated_page, main_texts, model

ARTICLE = "<p>" + "A sentence of the article, with some words in it. " * 4 + "</p>"


@pytest.fixture(scope="module")
def trees():
    return model()


def text_of(trees, page):
    return main_texts([page], trees)[0]


def test_accuracy_on_pages_not_trained_on(trees):
    rng, right, total = random.Random(987), 0, 0
    for _ in range(150):
        nodes, kept = generated_page(rng)
        got = np.array(decode(nodes, trees.log_odds(features(nodes))))
        with_text = np.array([bool(n.pieces) for n in nodes])
        right += (got == kept)[with_text].sum()
        total += with_text.sum()
    assert right / total >= 0.98


def test_nothing_is_kept_below_a_dropped_node():
    rng = np.random.default_rng(1)
    for _ in range(50):
        nodes, _ = generated_page(random.Random(int(rng.integers(10**6))))
        odds = rng.normal(0, 4, len(nodes))
        kept = decode(nodes, odds)
        assert all(kept[n.parent] or not k for n, k in zip(nodes[1:], kept[1:]))


def test_decoding_is_the_likeliest_choice():
    nodes = read("<div><p>a</p><div><p>b</p><p>c</p></div></div>")
    rng = np.random.default_rng(2)

    def value(kept, odds):
        return sum(-np.logaddexp(0, -o if k else o) for k, o in zip(kept, odds))

    for _ in range(30):
        odds = rng.normal(0, 2, len(nodes))
        best = max((value(k, odds) for m in range(1 << len(nodes)) if m & 1
                    for k in [[bool(m >> i & 1) for i in range(len(nodes))]]
                    if all(k[n.parent] or not x for n, x in zip(nodes[1:], k[1:]))))
        assert value(decode(nodes, odds), odds) == pytest.approx(best)


def test_parts_of_a_page(trees):
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
            "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><!-- <p>no</p> -->"
            "<div class=\"cookie-notice\"><p>We use cookies.</p></div>"
            f"<article><h1>The &amp; title</h1>{ARTICLE}<p>One<br>two \n\t three &copy &eacute;</p>"
            "<script>var x='<p>no</p>';</script>"
            f"<ul><li>First point of it.</li><li>Second point of it.</li></ul>{ARTICLE}</article>"
            "<aside class=\"sidebar\"><p>Also read this.</p></aside>"
            "<section class=\"comments\"><div class=\"comment\"><p>Nice!</p></div></section>"
            "<form class=\"newsletter\"><p>Subscribe now</p></form><footer>&copy; me</footer></body></html>")
    lines = text_of(trees, page).split("\n\n")
    sentence = ("A sentence of the article, with some words in it. " * 4).strip()
    assert lines == ["The & title", sentence, "One two three © é", "First point of it.", "Second point of it.", sentence]


LOOSE = "A sentence of the article, with some words in it, and then another one. " * 6


def test_article_directly_in_the_body(trees):
    nav = '<nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
    footer = '<footer class="site-footer">&copy; me</footer>'
    for inner in (f"{LOOSE}<br><br>{LOOSE}", f"<center>{LOOSE}<br>{LOOSE}</center>", f"<font>{LOOSE}</font><br>{LOOSE}",
                  f"<app-article><span>{LOOSE}</span> {LOOSE}</app-article>"):
        for page in (f"<html><head><title>x</title></head><body>{nav}<h1>The title of it</h1>{inner}{footer}</body></html>",
                     f"<html><body>{nav}{inner}{footer}", f"{nav}<h1>The title of it</h1>{inner}{footer}"):
            lines = text_of(trees, page).split("\n\n")
            assert " ".join((LOOSE * 2).split()) == lines[-1] and set(lines[:-1]) <= {"The title of it"}
    mixed = f"<body>{nav}<h1>The title of it</h1>{ARTICLE}{LOOSE}{ARTICLE}{LOOSE}{footer}</body>"
    assert len(text_of(trees, mixed).split("\n\n")) == 5


def test_loose_menus_are_dropped(trees):
    links = " | ".join(f'<a href="/{i}">Menu point</a>' for i in range(6))
    page = f"<body>{links}<article><h1>T</h1>{ARTICLE * 3}</article></body>"
    assert "Menu" not in text_of(trees, page) and "sentence" in text_of(trees, page)


def test_unclosed_elements_end_with_their_parent():
    def texts(page):
        return [t for _, t in sorted(b for x in read(page) for b in x.pieces)]

    for tag in ("object", "select", "option", "svg", "math", "template", "iframe"):
        assert texts(f"<div><p>a</p><div><{tag}>no</div><p>b</p></div>") == ["a", "b"]
        assert texts(f"<ul><li>a <{tag}>no<li>b</ul><p>c</p>") == ["a", "b", "c"]
        assert texts(f"<div><{tag}>no</div><p>b</p><div><{tag}>no</{tag}>c</div>") == ["b", "c"]
        assert texts(f"<p>a <span><{tag}>no</span> b</p>") == ["a b"]
        assert texts(f"<div><{tag}><p>no</p></{tag}>b</div>") == ["b"]
    assert texts("<p>a<object><p>no</p></object>b</p>") == ["ab"] or texts("<p>a<object><p>no</p></object>b</p>") == ["a b"]
    assert texts("<div><datalist><option>x<option>y</datalist>b</div>") == ["b"]
    assert texts("<p>a</p><script>no<p>no</p>") == ["a"]


def test_broken_pages(trees):
    for page in (None, "", "<", "<p", "<!--", "<script>", "<a href='", "</p></div>", "<div class=\"x"):
        assert text_of(trees, page) in ("", "<")
    assert text_of(trees, "just text &lt; here") == "just text < here"
    assert "words" in text_of(trees, f"<html><body><article><h1>T</h1>{ARTICLE}<p>last &am")
    deep = "<div>" * 3000 + "<p>deep</p>"
    assert isinstance(text_of(trees, deep), str)
    assert features(read("<p>a</p>")).shape == (2, len(FEATURES))


def test_rows(spark, trees):
    page = f"<body><article><h1>T</h1>{ARTICLE * 3}</article></body>"
    df = spark.createDataFrame([(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, "y")],
                               "page_id long, url string, html string, text string")
    rows = extracted(df, trees).collect()
    assert [r.page_id for r in rows] == [1, 1, None] and rows[0] == rows[1]
    assert rows[2].text == "" and rows[2].n_chars == 0 and rows[0].n_chars == len(rows[0].text) > 100
    assert extracted(df.limit(0), trees).count() == 0
