from __future__ import annotations

import time

import random

import numpy as np
import pytest

from tallyforge.llm import html_extract as H
from tallyforge.llm.html_blocks import leaf_blocks

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


def texts(page):
    return [b.text for b in leaf_blocks(page)]


def test_leaf_blocks():
    assert texts(None) == texts("") == texts("   <p> \n </p>") == []
    assert texts("plain  text\n more") == ["plain text more"]
    assert texts("<p>a<p>b <b>c</b>d<br>e</p>f") == ["a", "b cd e", "f"]
    assert texts("<p><b>open<br><p>next</p><ul><li>x<li>y</ul>") == ["open", "next", "x", "y"]
    assert texts("a<!-- <p>no</p> -->b<script>var t='</p><p>no';</script>c<STYLE>no</STYLE >d") == ["abcd"]
    assert texts("&lt;b&gt; &amp;amp; &copy;&nbsp;x &#233;&#x1F389;") == ["<b> &amp; © x é🎉"]
    assert texts("<p title='a > b'>x</p><p title=\"</p>\">y</p>") == ["x", "y"]
    assert texts("before<!-- never closed <p>no</p>") == ["before"]
    assert texts("x < y and 1 <2 <") == ["x < y and 1 <2 <"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after") == ["deep", "after"]
    assert leaf_blocks('<html><div class="Ad big" id=x1><a href=u>go</a> on</div>')[0] == ("go on", ("html", "div ad big x", "a"), 2)


def test_paths_around_deep_elements():
    deep = "<div>" * 5000 + "<aside class=ad>in<p>more</p></aside>" + "</div>" * 5000
    blocks = leaf_blocks(f"<html><body><div><article><p>a</p>{deep}<p>b</p></article></div><footer>f</footer>")
    path = ("html", "body", "div", "article")
    assert [b.text for b in blocks] == ["a", "in", "more", "b", "f"]
    assert blocks[0].path == blocks[3].path == (*path, "p") and blocks[4].path == ("html", "body", "footer")
    assert H.path_features(blocks[2].path) == H.path_features((*path, *["div"] * 5000, "aside ad", "p"))
    unclosed = leaf_blocks("<div>" * 300 + "<p>x</p><nav>n</nav><footer id=f>y</footer><div>z")
    assert [b.path[-1] for b in unclosed] == ["p", "nav", "footer f", "div"] and "nav" not in unclosed[3].path


def brute_decode(crf, scores):
    best = None
    for code in range(2 ** len(scores)):
        labels = [code >> i & 1 for i in range(len(scores))]
        total = crf.first * labels[0] + sum(s for s, y in zip(scores, labels) if y) + sum(crf.edges[a, b] for a, b in zip(labels, labels[1:]))
        if best is None or total > best[0]:
            best = (total, labels)
    return best[0], best[1]


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(1)
    for _ in range(60):
        crf = H.Crf({}, np.empty(0), rng.normal(size=(2, 2)), float(rng.normal()))
        scores = rng.normal(size=rng.integers(1, 9)) * 2
        labels = crf.decode(scores).tolist()
        total = crf.first * labels[0] + sum(s for s, y in zip(scores, labels) if y) + sum(crf.edges[a, b] for a, b in zip(labels, labels[1:]))
        assert np.isclose(total, brute_decode(crf, scores)[0])
    assert crf.decode(np.empty(0)).tolist() == []


def log_likelihood(crf, pages):
    total = 0.0
    for blocks, labels in pages:
        scores = [sum(crf.weights[crf.features[f]] for f in H.path_features(b.path) + H.text_features(b, i, len(blocks))) for i, b in enumerate(blocks)]
        ways = []
        for code in range(2 ** len(scores)):
            y = [code >> i & 1 for i in range(len(scores))]
            ways.append(crf.first * y[0] + sum(s for s, k in zip(scores, y) if k) + sum(crf.edges[a, b] for a, b in zip(y, y[1:])))
        own = crf.first * labels[0] + sum(s for s, k in zip(scores, labels) if k) + sum(crf.edges[a, b] for a, b in zip(labels, labels[1:]))
        total += own - np.logaddexp.reduce(ways)
    return total


def test_training_climbs_the_conditional_likelihood():
    pages = []
    for i in range(6):
        blocks = leaf_blocks(f"<nav><a>x{i}</a></nav><p>Some text, number {i}.</p><p>More of it.</p><footer>f</footer>")
        pages.append((blocks, [0, 1, int(i < 5), 0]))
    few, many = (H.train(pages, penalty=1e-4, rounds=n) for n in (3, 150))
    assert log_likelihood(H.train(pages, rounds=0), pages) < log_likelihood(few, pages) < log_likelihood(many, pages)
    # at the optimum moving any weight loses
    base = log_likelihood(many, pages)
    for step in (0.5, -0.5):
        moved = H.Crf(many.features, many.weights + step * (np.arange(len(many.weights)) == many.features["tag p"]), many.edges, many.first)
        assert log_likelihood(moved, pages) < base + 0.1


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


LAYOUT = """<html><head><title>T</title><style>p{{}}</style></head><body><div class="cookie notice">We use cookies.</div>
<header><a href=/>Site</a><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></header><aside class=sidebar><h3>Related</h3><a href=x>Other story</a></aside>
<{wrap}><h1>Title &amp; more</h1><p>The first paragraph, with  some words.</p><script>no()</script><p>Second <i>one</i>.</p></{end}>
<div id=comments><h3>Comments</h3><div class=comment><p>I liked this story a lot, thank you.</p></div></div>
<form class=login><label>Name</label><input><button>Go</button></form><footer>&copy; 2020 Site</footer></body></html>"""


@pytest.mark.parametrize("wrap", ["article", "main", "div class=content", "div id=main-content"])
def test_main_text_of_layouts(model, wrap):
    page = LAYOUT.format(wrap=wrap, end=wrap.split()[0])
    assert model.main_text(page, {}) == "Title & more\nThe first paragraph, with some words.\nSecond one."


def test_held_out_layouts(model):
    dice = random.Random(3)
    words = "river stone garden window morning people table walk green house".split()
    parts = [([" ".join(dice.choices(words, k=dice.randint(3, 40))) + "." for _ in range(8)], [" ".join(dice.choices(words, k=3)) for _ in range(5)]) for _ in range(20)]
    wrong = total = 0
    for blocks, labels in H.labelled_layouts(parts, seed=77):
        scores = np.array([sum(model.weights[model.features[f]] for f in H.path_features(b.path) + H.text_features(b, i, len(blocks)) if f in model.features) for i, b in enumerate(blocks)])
        wrong += int((model.decode(scores) != labels).sum())
        total += len(labels)
    assert wrong <= 0.02 * total


def test_every_row_has_a_text(spark, model):
    page = LAYOUT.format(wrap="article", end="article")
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<p>"), (1, "u", page), (None, "u", page), (5, "u", "<article>" + "<p>long é text</p>" * 50_000 + "</article>")]
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    found = H.extract(table, model).collect()
    assert len(found) == 7 and found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    text = {r["page_id"]: r["text"] for r in found}
    assert text[1] == text[None] and text[1].startswith("Title") and text[2] == text[3] == text[4] == ""
    assert text[5] == "\n".join(["long é text"] * 50_000) and all(r["n_chars"] == len(r["text"]) for r in found)


def test_no_pages_and_no_articles(spark):
    empty = spark.createDataFrame([], SCHEMA)
    plain = spark.createDataFrame([(1, "u", "<div>x</div>", None, None)], SCHEMA)
    for table in (empty, plain):
        assert H.extract(table, H.fit(table)).count() == table.count()


@pytest.mark.parametrize("unit", ['<a "', "<a ", "<a", "<!", "</", "<a '\"x", "<a \"' ", "<p><b>", "<li>", "&#1"])
@pytest.mark.parametrize("tail", ["", "x>y"])
def test_broken_markup_takes_time_as_its_length(unit, tail):
    began = time.monotonic()
    leaf_blocks("<p>first</p>" + unit * (1_000_000 // len(unit)) + tail)
    assert time.monotonic() - began < 20


def test_start_tags_below_many_open_elements_take_no_search():
    began = time.monotonic()
    blocks = leaf_blocks("<p><button>" + "<b>" * 50_000 + "<h1>x</h1>" * 50_000)
    assert len(blocks) == 50_000 and time.monotonic() - began < 20


def test_tags_that_never_end_are_text():
    assert texts("<p>a < b <c") == ["a < b <c"]
    assert texts("<a \"x <b>y</b>") == ['<a "x', "y"] or texts("<a \"x <b>y</b>") == ['<a "x y']
    assert texts("a</>b<!>c<?x>d") == ["abcd"]
    assert texts("<div title='a>b' class=\"c\">x</div>") == ["x"]


def test_number_references_of_any_length():
    assert texts("<p>a&#" + "1" * 6000 + ";b&#" + "0" * 6000 + "65;c&#0;&#x41;</p>") == ["a�bAc�A"]


def test_training_takes_whole_pages_up_to_its_bound(spark):
    page = "<nav><a>menu</a></nav><article>" + "<p>Some sentence of the text.</p>" * 200 + "</article><footer>end of the page</footer>"
    rows = [(i, page) for i in range(4)] + [(9, "<p>" + "x" * 60_000)]
    seen = []
    learn = H.train
    try:
        H.train = lambda pages, *rest: seen.extend(pages) or learn(pages[:8], *rest)
        H.fit(spark.createDataFrame(rows, "page_id long, html string"))
    finally:
        H.train = learn
    own = [(blocks, labels) for blocks, labels in seen if len(blocks) == 202 and blocks[0].text == "menu"]
    assert len(own) >= 4 and all(sum(labels) == 200 and labels[-1] == 0 for _, labels in own[:4])
    assert max(len(b.text) for blocks, _ in seen for b in blocks) < 1000
