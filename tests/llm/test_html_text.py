"""HTML extraction."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from duskline.llm import html_text
from duskline.llm.html_text import ARTICLE, ASIDE, LOOSE, blocks

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("Text", T.StringType())])


@pytest.mark.parametrize(
    "page, want",
    [
        (None, []),
        ("", []),
        ("plain &amp; simple", [("plain & simple", LOOSE)]),
        ("<article><h1>A &lt;b&gt;</h1><p>x<b>y</b>\n z<br>w<p>v</article>t", [("A <b>", ARTICLE), ("xy z", ARTICLE), ("w", ARTICLE), ("v", ARTICLE), ("t", LOOSE)]),
        ("<nav><ul><li>a</li></ul></nav><main>m</main><footer>f</footer>", [("a", ASIDE), ("m", ARTICLE), ("f", ASIDE)]),
        ('<div class="ad">x<div>y</div></div><div class="adapter">z</div>', [("x", ASIDE), ("y", ASIDE), ("z", LOOSE)]),
        ("<script>var a='</p><p>';</script><style>p{}</style><!-- <p>c --><p>d", [("d", LOOSE)]),
        ('<article>a<div id="comments"><p>c</p></div><form><label>l</label></form>b</article>', [("a", ARTICLE), ("c", ASIDE), ("l", ASIDE), ("b", ARTICLE)]),
        ('<article><p class="notice">n<p>b</p></article>', [("n", ASIDE), ("b", ARTICLE)]),
        ('<p title="a > b">q</p><p hidden>h</p>', [("q", LOOSE), ("h", ASIDE)]),
        ("a < b <3 c", [("a < b <3 c", LOOSE)]),
        ('<p class="x>broken<b>t', [("brokent", LOOSE)]),
        ("<article><p>open", [("open", ARTICLE)]),
        ("<body class='nav-open'><p>t</p></body>", [("t", LOOSE)]),
        ("<span class=ad>x</span>y", [("x", ASIDE), ("y", LOOSE)]),
    ],
)
def test_blocks(page, want):
    assert blocks(page) == want


def length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(30))
def test_common_lines(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(6) for _ in range(rng.randrange(25))] for _ in range(2))
    marked = html_text.common_lines(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
    common = [x for x, m in zip(a, marked) if m]
    assert len(common) == length(a, b)
    rest = iter(b)
    assert all(x in rest for x in common)


def run(spark, rows):
    return {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_neighbour_lines_go_without_a_marked_article(spark):
    page = "<div>Home</div><div>All news</div><p>{}</p><p>Own line {}</p><div>Contact us</div>"
    rows = [(i, f"http://h.example/news/{i}", page.format(f"Story {i}", i), None) for i in range(8)]
    rows += [(100, "http://other.example/x", page.format("Alone", 1), None)]
    got = run(spark, rows)
    for i in range(8):
        assert got[i] == f"Story {i} Own line {i}"
    assert got[100] == "Home All news Alone Own line 1 Contact us"


def test_copies_of_an_article_stay(spark):
    page = "<nav>n</nav><article><h1>T</h1><p>Same text</p></article><footer>f</footer>"
    bare = "<p>Same</p><p>text</p>"
    rows = [(1, "http://h/a", page, None), (2, "http://h/b", page, None), (3, "http://k/a", bare, None), (4, "http://k/b", bare, None)]
    assert run(spark, rows) == {1: "T Same text", 2: "T Same text", 3: "Same text", 4: "Same text"}


def test_nulls_repeats_long_and_empty(spark):
    rows = [(1, None, None, None), (2, None, "<p>x", None), (None, "not a url", "<p>y", "clash"), (3, "http://h/", "<article>" + "<p>w w</p>" * 20_000, None)]
    got = run(spark, rows)
    assert got[1] == "" and got[2] == "x" and got[None] == "y" and len(got[3]) == 4 * 20_000 - 1
    twice = html_text.extract(spark.createDataFrame([rows[1]] * 3, PAGES))
    assert twice.columns == ["page_id", "url", "html", "text"] and twice.count() == 3
    assert html_text.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_every_page_meets_its_nearest(spark):
    paths = ["/a", "/a/b", "/a/bc", "/b/x", "/b/xy", "/z"]
    keys = spark.createDataFrame([("h", p, i) for i, p in enumerate(paths)] + [("k", "/a", 9)], "host string, path string, row long")
    near = {r["row"]: r["near"] for r in html_text._neighbours(keys).collect()}
    assert near == {0: 1, 1: 2, 2: 1, 3: 4, 4: 3, 5: 4, 9: None}


def test_pages_with_a_marked_article_are_differenced(spark):
    """What the markup leaves open beside the article goes if the neighbour has it and stays if not."""
    page = "<nav>n</nav><div>Our site</div><div><h1>Title {0}</h1></div><article><p>Quoted</p><p>Body {0}</p></article><div class=ad>ad {0}</div><div>Call us</div>"
    rows = [(i, f"http://h.example/news/{i}", page.format(i), None) for i in range(6)]
    rows += [(10, "http://alone.example/1", page.format(10), None), (11, "http://c.example/1", page.format(11), None), (12, "http://c.example/2", page.format(11), None)]
    rows += [(20, "http://h.example/news/3", page.format(3), None)]  # a repeated row is not its own neighbour
    got = run(spark, rows)
    assert {i: got[i] for i in range(6)} == {i: f"Title {i} Quoted Body {i}" for i in range(6)}
    assert got[10] == "Quoted Body 10" and got[11] == got[12] == "Quoted Body 11" and got[20] == got[3]
