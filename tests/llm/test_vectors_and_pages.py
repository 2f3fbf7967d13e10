"""Top-k search against brute force, and main text of pages."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerspark.llm import topk
from ledgerspark.llm.pages import aligned, content, expression, extracted, joined, main_text, parsed, wrapper_of
from ledgerspark.llm.topk import embedding_top_k, segment_features


def expected_top(rows, every, k=10):
    known = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in known:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, vector in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in known if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("rows, queries", [(4096, 512), (16, 3)])
def test_top_k(spark, monkeypatch, rows, queries):
    monkeypatch.setattr(topk, "CELL_ROWS", rows)
    monkeypatch.setattr(topk, "CELL_QUERIES", queries)
    rng = random.Random(1)
    data = [(i, [rng.gauss(0, 1) for _ in range(20)], "x") for i in range(150)]
    data += [(200 + i, data[7][1], "copy") for i in range(20)] + [(300, data[0][1], "tie"), (10, [0.5] * 20, "again")]
    data += [(400, None, ""), (401, [], ""), (402, [1.0, None], ""), (403, [float("nan")] * 20, ""), (404, [float("inf")] * 20, ""),
             (None, [1.0] * 20, ""), (410, [1.0, 2.0], "short"), (420, [0.0] * 20, "zero")]
    frame = spark.createDataFrame([(i, v, s, 3) for i, v, s in data], "vec_id long, embedding array<float>, score string, rank int").repartition(4)
    found = sorted(map(tuple, embedding_top_k(frame, every=10).select("query_id", "rank", "vec_id", "score").collect()))
    assert found == expected_top(data, 10)
    assert embedding_top_k(frame.limit(0)).count() == 0


def test_huge_components_stop_at_the_range(spark):
    frame = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [-1e30, 2.0])], "vec_id long, embedding array<float>")
    found = {(r.query_id, r.vec_id): r.score for r in embedding_top_k(frame).collect()}
    assert found == {(0, 1): 2**63 - 1, (0, 2): -(2**63)}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 20), st.integers(0, 10_000))
def test_segment_bounds_hold(width, segments, seed):
    rows = np.random.default_rng(seed).integers(-2000, 2000, (6, width)).astype(float)
    features = segment_features(rows, segments)
    assert (features @ features.T + 1e-6 * (1 + np.abs(rows).max() ** 2) * width >= rows @ rows.T).all()


PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy</div>
<article><h1>Title &amp; more</h1><p><b>First <i>pa</i>ragraph</b> with&nbsp;space<br>and   break<p>Second &lt;tag&gt;</p>
<form><input value="x"><p>Sign up</p></form><aside>Related</aside></article>
<section id="comments"><article class="comment"><p>Reader</p></article></section><div class="cookie-notice">Ok?</div>
<footer>&copy; Site</footer></body></html>"""
TEXT = "Title & more First paragraph with space and break Second <tag>"


def read(page):
    own = wrapper_of(parsed(page))
    return " ".join(extracted(parsed(page), own, content(own)))


def test_one_page():
    assert read(PAGE) == TEXT
    assert read(PAGE.split("<footer>")[0]) == TEXT


def test_page_without_article():
    page = """<div><a href=1>Home</a> | <a href=2>About the site</a></div><div><p>The text of the page is here.</p>
    <ul><li>With a list</ul></div><div class="footer">Foot</div>"""
    assert read(page) == "The text of the page is here. With a list"


@pytest.mark.parametrize("page", ["", "<", "<p", "a < b", "<!-- x", "<div " * 500, "<div>" * 3000 + "x", "</p></p>", "<script>x",
                                  "<p title='>'>x", "&#0;&bogus;", "<a><b><table><tr><td>x", "\x00"])
def test_broken_pages(page):
    read(page)


@pytest.mark.parametrize("deep", [0, 40, 60, 3000])
def test_deep_elements_end_where_they_end(deep):
    """Ends below the deepest level close no element above it, and what is apart there stays apart."""
    inner = f"{'<div>' * deep}Deep text<aside>Apart <div>and inside</div> of it</aside> goes on{'</div>' * deep}"
    page = f"<div><article><p>First paragraph.</p>{inner}<p>Last paragraph.</p></article></div><div>Outside</div>"
    assert read(page) == "First paragraph. Deep text goes on Last paragraph."
    article = "<article><p>The text.</p><nav>Menu <p>in it</p></nav><p>More of it.</p></article>"
    assert read(f"{'<div>' * deep}<p>Before</p>{article}<p>After</p>{'</div>' * deep}") == "The text. More of it."


def test_wrappers_are_union_free():
    pages = ["<article><h1>A</h1><p>x</p></article><footer>same</footer>",
             "<article><h1>B</h1><p>y</p><p>z</p></article><footer>same</footer>",
             "<div class=ad>ad</div><article><h1>C</h1></article><footer>same</footer>"]
    wrapper = wrapper_of(parsed(pages[0]))
    for page in pages[1:]:
        joined(wrapper, wrapper_of(parsed(page)))
    assert expression(wrapper) == ("<html>(<div.ad>#TEXT</>)?<article><h1>#TEXT</>(<p>#TEXT</>)+?</>"
                                   "<footer>\"same\"</></>")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
def test_alignment_keeps_both_orders(a, b):
    pairs = aligned(a, b)
    assert [a[i] for i, _ in pairs if i is not None] == a and [b[j] for _, j in pairs if j is not None] == b
    assert all(a[i] == b[j] for i, j in pairs if i is not None and j is not None)


def test_main_text_of_odd_pages(spark):
    rows = [(1, "http://h/1", PAGE, "t"), (2, None, PAGE, "t"), (3, "http://h/2", None, "t"), (4, "http://h/3", "", "t"),
            (1, "http://h/1", PAGE, "t"), (None, "nonsense", PAGE, "t"), (6, "http://h/4", "<p>other form</p>", "t"),
            (7, "http://long/", "<article>" + "<p>word</p>" * 30_000 + "</article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    found = sorted(map(tuple, main_text(pages).collect()), key=str)
    texts = {1: TEXT, 2: TEXT, 3: "", 4: "", None: TEXT, 6: "other form", 7: " ".join(["word"] * 30_000)}
    assert found == sorted(((i, u, texts[i], len(texts[i])) for i, u, *_ in rows), key=str)
    assert main_text(pages.limit(0)).count() == 0


def test_main_text_of_the_test_pages(spark):
    """The generated pages have one article each, with blocks by headings and paragraphs."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in main_text(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = (html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split() for b in re.split(r"</?(?:p|h1)>", article))
        assert found[row.page_id] == " ".join(" ".join(b) for b in blocks if b)
