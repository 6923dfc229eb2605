"""HTML extraction: markup of every kind, the style tree, and the given pages."""

import html
import math
import re
import time

import pytest

from tripmill.llm import html_text as X


def alone(text):
    """The main text of a page without others of its site."""
    return X.main_text(X.parse(text), set())


@pytest.mark.parametrize("text, expected", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a b"), ("a<br>b<BR/>c", "a b c"), ("<div>x<b>y</b>z</div>", "xyz"),
    ("<ul><li>a<li>b</ul>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<dl><dt>a<dd>b<dt>c</dl>", "a b c"),
    ("x < y <3 &lt;i&gt; &amp;&nbsp;z &copy;&#8364;&#x41;", "x < y <3 <i> & z ©€A"), ("&am x", "&am x"),
    ("<p>un<!-- c --> closed <!-- more", "un closed"), ("<script>a</scr</script>t", "t"), ("<title>abc", ""),
    ('<a href="x>y">q</a>z', "qz"), ("<p title='a>b'>t</p>", "t"), ("<p>a</p >b<p\n>c", "a b c"), ("</div></p>y", "y"),
    ("<style>p{}</style>t<noscript>n</noscript>", "t"), ("<textarea>x</textarea>y", "y"), ("<form>f<input>g</form>t", "t"),
    ("<nav>n</nav><header>h</header>t<aside>s</aside><footer>f</footer>", "t"), ("<div role=alert>n</div>t", "t"),
    ('<div class="cookie-banner">c</div><div id="topBanner">b</div>t<div class=sidebar-2>s</div><p class="ad ad-300">a', "t"),
    ('<body class="no-sidebar"><p class="has-comments">t</p>', "t"), ("<div class='reader-comments'><article>c</article></div>t", "t"),
    ("<body><h1>out</h1><article><header><h1>T</h1></header><p>x</p><aside>no</aside></article><p>after</p>", "T x"),
    ("<main><p>lead</p><article>a</article></main><p>b</p>", "lead a"), ("<article>a</article><p>b</p><article>c</article>", "a c"),
    ("<article>a</article><article class='comment'>b</article>", "a"), ("<div class='post-content'>a</div><p>b</p>", "a"),
    ("<div class='post-header'><h1>t</h1></div>", "t"), ("<article></article><p>b</p>", "b"),
    ("<article><p><b>t<br><p>u</p></article>v", "t u"), ("<head><title>t</title><p>x", "x"), ("<pre>a\n  b</pre>", "a b"),
    ("<div> a\x0bb </div>", "a b"), ("<nav>only</nav>", ""), ("<article>cut <a href='", "cut"), ("<![CDATA[x]]>y<?php z ?>", "y"),
    ("<svg><text>s</text></svg>t", "t"), ("<select><option>a<option>b</select>t", "t"), ("<p>a<div>b</div>c", "a b c"),
])
def test_markup(text, expected):
    assert alone(text) == expected


@pytest.mark.parametrize("text", [
    "<div>" * 100_000 + "x", "<p>" * 100_000, '<a "' * 100_000, "<a '\"" * 100_000, "<!--" * 100_000, "</x>" * 100_000,
    "<" * 100_000, "&" * 100_000, "<li>" * 100_000, "<ul><li>" * 50_000 + "</ul>" * 3, "<a " + "x" * 200_000 + " y=1>",
    "<a " + " " * 200_000 + "y=1>", "<a x=" + "y=" * 100_000 + ">z", "<b>" * 50_000 + "</i>" * 50_000, "<!" * 100_000,
    '<div class="' + "a " * 100_000 + '">t', "<script>" * 50_000, "<table><tr><td>" * 30_000, "<a y='1 " + "x= " * 100_000 + "'>",
])
def test_odd_markup_takes_linear_time(text):
    begun = time.process_time()
    alone(text)
    assert time.process_time() - begun < 8


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in X.extract_text(pages).collect()}
    assert len(got) == pages.count()
    for row in pages.collect():
        body = re.search("<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        plain = re.sub("<[^>]*>", " ", re.sub("</?b>", "", body))
        text = " ".join(html.unescape(plain).split())
        assert (got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (text, len(text))


@pytest.fixture(scope="module")
def unnamed(spark):
    """Sites without a telling tag or class: a menu, a text per page, a notice."""
    rows = []
    for site, pages in (("a.example", 40), ("b.example", 12), ("one.example", 1)):
        for i in range(pages):
            menu = "".join(f"<li><a href='/{k}'>Section {k}</a></li>" for k in range(5))
            text = f"<p>Page {i} of {site} tells of thing {i * 7}.</p>" * (1 + i % 3)
            rows.append((len(rows), f"http://{site}/{i}", f"<html><body><div><ul>{menu}</ul></div><div class=x{i}><div>{text}</div>"
                         "</div><div><p>All rights reserved by us.</p></div></body></html>"))  # fmt: skip
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_branches_alike_on_all_pages_go(unnamed):
    for row in X.extract_text(unnamed).collect():
        number = row["url"].rsplit("/")[-1]
        site = row["url"].split("/")[2]
        times = 1 + int(number) % 3
        expected = " ".join([f"Page {number} of {site} tells of thing {int(number) * 7}."] * times)
        if site == "one.example":  # one page is no evidence
            assert expected in row["text"] and "Section 3" in row["text"]
        else:
            assert row["text"] == expected


def test_importances_by_hand(spark):
    pages = [f"<div><p>same</p></div><div class=c><p>text {i}</p><p>more {i}</p></div>" for i in range(8)]
    df = spark.createDataFrame([(f"http://s/{i}", p) for i, p in enumerate(pages)], "url string, body string")
    given = df.selectExpr("xxhash64(url) AS ha", "1L AS hb", "'s' AS site", "body")
    nodes = X.map_arrow(given, X._node_rows, X._NODES_DDL)
    got = {r["node"]: r["importance"] for r in X.style_tree(nodes).collect()}
    page = X.parse(pages[0])
    by_path = {}
    for (above, signature), number in page.number.items():
        by_path[(page.keys[above] if above >= 0 else None, signature)] = page.keys[number]
    root = by_path[None, "#page"]
    plain, named = by_path[root, "div"], by_path[root, "div class=c"]
    same, own = by_path[plain, "p"], by_path[named, "p"]
    # 8 pages, one text on all: entropy 1, counted 7/8. Two texts a page, each on one page: 0.
    assert math.isclose(got[same], 1 / 8) and got[own] == 1.0
    assert math.isclose(got[plain], 0.9 / 8) and math.isclose(got[named], 0.9)
    assert math.isclose(got[root], 0.9 * (0.9 / 8 + 0.9) / 2)


def test_repeated_articles_stay(spark):
    body = "<nav>menu</nav><article><h1>T</h1><p>the same text on every page</p></article><footer>f</footer>"
    df = spark.createDataFrame([(i, "http://x.org/a", body) for i in range(50)], "page_id long, url string, html string")
    assert {r["text"] for r in X.extract_text(df).collect()} == {"T the same text on every page"}
    bare = df.selectExpr("page_id", "url", "'<div>the same text on every page</div>' AS html")
    assert {r["text"] for r in X.extract_text(bare).collect()} == {"the same text on every page"}


def test_odd_rows(spark):
    rows = [
        (1, "http://a/x", "<p>one</p>", "k", 5), (1, "http://a/x", "<p>one</p>", "k", 5), (None, None, None, None, None),
        (2, None, "<p>two</p>", "k", 6), (3, "no host", "", "t", 7), (4, "HTTP://B/y", "<p>" + "long text " * 60_000, "t", 8),
        (5, "http://b/z", "<div>" * 300 + "deep<nav>menu</nav>" + "</div>" * 300, "t", 9),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, low int")
    out = X.extract_text(df)
    assert out.columns == ["page_id", "url", "html", "text", "low", "n_chars"]
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"], r["low"]) for r in out.collect())
    long = ("long text " * 60_000).strip()
    assert got == sorted([
        ("1", "one", 3, 5), ("1", "one", 3, 5), ("None", "", 0, None), ("2", "two", 3, 6), ("3", "", 0, 7),
        ("4", long, len(long), 8), ("5", "deep", 4, 9),
    ])
    assert X.extract_text(df.filter("false")).collect() == []
