"""Articles of all block kinds, with and without names, and odd inputs through Spark."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from jobmart.llm import html_text

SENTENCES = "The committee met on Tuesday, and after a long debate it agreed to publish the results. Members were asked to comment, which few of them did."
ARTICLE = ["First point of the list", "Third point", "E=m here", "Results by year", "Year Count".split()[0], "2001", "17 cases", "hall, seen", "x = 1 y = x + 2",
           "Quorum", "members needed", "still image", "surprised", "Tom & Ann"]
OTHERS = ["Home", "Contact", "bob", "Nice", "Privacy", "2020", "Search here", "track("]


def page(named: bool) -> str:
    def name(word: str) -> str:
        return f' class="{word}"' if named else ""

    p = f"<p>{SENTENCES}</p>"
    return f"""<html><head><title>T</title><script>track(1)</script></head><body><div{name("menu")}><ul><li><a href="/">Home</a></li>
<li><a href="/n">News</a></li><li><a href="/s">Sport pages</a></li><li><a href="/c">Contact us</a></li></ul></div>
<div{name("article")}><h1>A long report on the committee.</h1>{p}{p}<ul><li>First point of the list, with some words.</li>
<li>Second point, shorter.</li><li>Third point of it, and more.</li></ul><p>{SENTENCES} Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here.</p>
<table><caption>Results by year</caption><tr><th>Year</th><th>Count</th></tr><tr><td>2001</td><td>17 cases</td></tr><tr><td>2002</td><td>25 cases</td></tr></table>
{p}<figure><img src="a.png"><figcaption>The hall, seen from the east.</figcaption></figure><pre>x = 1
y = x + 2</pre><dl><dt>Quorum</dt><dd>The members needed for a vote.</dd></dl><noscript>A still image of the chart.</noscript>
<blockquote>We were surprised, said Tom &amp; Ann.</blockquote>{p}</div>
<div{name("comments")}><h4>2 replies</h4><div><b>bob</b><p>Nice.</p></div><div><b>eve</b><p>I disagree!</p></div></div>
<form{name("search")}><label>Search here</label><input name="q"></form>
<div{name("footer")}><p><a href="/p">Privacy</a> | <a href="/t">Terms</a> &copy; 2020 Example</p></div></body></html>"""


@pytest.fixture(scope="module")
def model():
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet' where html is not null order by page_id limit 240").fetchall()
    return html_text.train([r[0] for r in rows])


@pytest.mark.parametrize("named", [True, False])
def test_nothing_of_an_article_is_lost(model, named):
    (text,) = model.texts([page(named)])
    assert [w for w in ARTICLE if w not in text] == []
    assert [w for w in OTHERS if w in text] == []


def test_given_pages_equal_their_article(model):
    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet' where html is not null").fetchall()
    sources = [r[0] for r in rows]
    want = [(p := html_text.Page(x)).main_text(html_text.labels(p) > 0) for x in sources]
    wrong = sum(a != b for a, b in zip(model.texts(sources), want, strict=True))
    assert wrong <= len(sources) // 100


def test_formulas_stay_in_their_block():
    p = html_text.Page("<p>a <math><mi>x</mi><mspace/><mo>+</mo></math> b</p><svg><text>c</text></svg><noscript>d</noscript><style>e</style>")
    assert p.main_text([True] * len(p.tags)) == "a x+ b\nc\nd"


def test_null_empty_and_clashing_columns_through_spark(spark, model):
    df = spark.createDataFrame([(1, None, "t", 9), (2, "", "t", 9), (3, page(True), "t", 9), (3, page(True), "t", 9)], "page_id long, html string, Text string, n_chars int")
    rows = html_text.extract(df, model).orderBy("page_id").collect()
    assert [(r.text, r.n_chars) for r in rows[:2]] == [("", 0), ("", 0)]
    assert rows[2].text == rows[3].text and rows[2].n_chars == len(rows[2].text) > 500
    assert html_text.extract(df.where("false"), model).count() == 0
    none = html_text.fit(df.where(F.col("html").isNull()))
    assert html_text.extract(df, none).count() == 4
