"""Block reader rules, and the labeller against layouts it has not seen."""

import html
import re

import duckdb
import pytest

from quarterline.llm import html_extract as H
from quarterline.llm import queries
from quarterline.llm.html_blocks import blocks

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_follow_html():
    assert texts("<p>a <b>b</b>c&amp;&#x41;&nbsp;\n d<br>e<p>f") == ["a bc&A d e", "f"]
    assert texts("<ul><li>x<li>y</ul>tail") == ["x", "y", "tail"]
    assert texts("<script>var t='</p><p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes") == ["yes"]
    assert texts("<div hidden>no</div><div style='display:none'>no</div><div>yes</div>") == ["yes"]
    assert texts('<a title="1 > 0">link</a> 1 < 2 &lt;p&gt;') == ["link 1 < 2 <p>"]
    assert texts("<!-- open comment <p>x") == [] and texts("<script>open") == [] and texts("") == []
    assert texts("<p></p><table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]


def test_quotes_open_a_value_only_after_an_equals_sign():
    assert texts("<p title=it's>Hello world, it's fine</p><p>More isn't less</p>") == ["Hello world, it's fine", "More isn't less"]
    assert texts("<p 'x>a</p><p \"y>b</p><p z = 'q>q'>c</p>") == ["a", "b", "c"]
    assert texts('<p>a <span aria-hidden="true">5 km</span> b</p>') == ["a 5 km b"]  # shown to readers
    assert texts('<p title="the hidden cost">a</p><p hidden="">no</p>') == ["a"]
    assert texts("<p>x<!-- open <b>c") == ["x"] and texts("a <b") == ["a <b"] and texts("x > y") == ["x > y"]


@pytest.mark.parametrize("page", ["<a '", "<div>x", '<a x="', "<b>", "<", "<!--", "<script", "<a =", "<p>x</p", "<![CDATA["])
def test_reader_takes_linear_time(page):
    import time

    def seconds(n):
        start = time.perf_counter()
        blocks(page * n)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(16000) < 16 * max(0.05, seconds(4000))


def test_text_is_what_the_parser_of_the_library_sees():
    """Random pages: all text outside unseen elements, white space aside, as Python's own HTML parser gives it."""
    import random
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.skip, self.seen = 0, []

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "title", "textarea")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "title", "textarea") and self.skip > 0

        def handle_data(self, data):
            if not self.skip:
                self.seen.append(data)

    rng = random.Random(8)
    attrs = ["", " class=a", " title=it's", " x='1 > 0'", ' y="2 < \'3\'"', " 'odd", " href=/a/b", " a = b", " data-x"]
    for _ in range(400):
        page = ""
        for _ in range(rng.randrange(1, 25)):
            tag = rng.choice(["p", "div", "b", "i", "li", "td", "h2", "span"])
            page += rng.choice([f"<{tag}{rng.choice(attrs)}>", f"</{tag}>", "word ", "a&amp;b ", "it's ", "<!-- c -->", "<br>",
                                "<script>var a='<p>';</script>", "<style>p{}</style>", "1 < 2 "])
        reader = Reader()
        reader.feed(page)
        reader.close()
        assert "".join("".join(texts(page)).split()) == "".join("".join(reader.seen).split()), page


@pytest.fixture(scope="module")
def model():
    pages = [r[0] for r in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' WHERE page_id % 2 = 0 ORDER BY page_id").fetchall()]
    return H.train(pages[:80], copies=5, rounds=10)


def test_held_out_pages_give_their_article(model):
    rows = duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet' WHERE page_id % 2 = 1").fetchall()
    good = 0
    for (page,), text in zip(rows, H.main_texts(model, [r[0] for r in rows])):
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        good += text == "\n".join(x for x in lines if x)
    assert good >= 0.98 * len(rows)


PAGE = """<html><body><header><a href=/>Site</a><p>The daily site of news</p></header><div id="menu"><ul><li><a href=a>World</a>
<li><a href=b>Sport</a></ul></div><div class="cookie-banner">We use cookies on this site. <button>Accept</button></div>
<div class="layout"><div class="post"><h1>A title here</h1><p>First paragraph of the story, with a <a href=x>link</a> &amp; more text
that goes on.</p><p>Second one, also rather long, about things.</p><div class="advert">Buy now! The best offers, only today.</div>
<p>Third paragraph ends the story here.</p></div><div class="sidebar"><h3>Popular</h3><ul><li><a href=1>One popular story</a></li>
</ul></div></div><div id="comments"><h3>2 comments</h3><div class="comment"><p>I really liked this story, it was great.</p></div></div>
<form><label>Name</label><input><button>Send</button></form><footer>Copyright 2024 The Site.</footer></body></html>"""


def test_other_layout(model):
    text = H.main_texts(model, [PAGE])[0]
    for kept in ("First paragraph of the story, with a link & more text that goes on.", "Second one", "Third paragraph"):
        assert kept in text
    for gone in ("World", "cookies", "Buy now", "Popular", "liked", "Send", "Copyright", "daily site"):
        assert gone not in text


def test_odd_pages(model):
    long = "<article>" + "<p>word word word, and so on it goes here.</p>" * 3000 + "</article>"
    got = H.main_texts(model, [None, "", " \n ", "<p>", long])
    assert got[:4] == ["", "", "", ""] and got[4].count("\n") >= 2900


def test_query_rows(spark):
    rows = queries.QUERIES["op2_html_extract"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 50 and all(r["n_chars"] == len(r["text"]) for r in rows)
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert H.extract(empty).count() == 0
    odd = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a", "y"), (None, None, "", "z")], "page_id long, url string, html string, text string")
    assert H.extract(odd).count() == 3


def test_only_unseen_text_is_left_out():
    assert texts('<p><svg class="i"/>one</p><p>two <math/>three<canvas /></p><script src="x.js"/><p>four') == ["one", "two three", "four"]
    assert texts("<p>Area <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here</p>") == ["Area x=2 here"]
    assert texts("<noscript><p>plain</p></noscript><object data=x>in <b>place</b></object><canvas>chart</canvas>") == ["plain", "in placechart"]
    assert texts("<p>a<svg><title>Sales</title><text>2023</text><text>2024</text></svg>") == ["a Sales 2023 2024"]
    assert texts("<title>Page</title><select><option>x<option>y</select><textarea><p>t</textarea><p>yes") == ["yes"]
    assert texts("<div><select><option>x</div><p>after") == ["after"] and texts("<title-bar>kept</title-bar>") == ["kept"]
    assert texts('<a title="a hidden gem">one</a><p title="the hidden cost">two</p><p data-x="display:none" alt=\'aria-hidden=true\'>three') == ["one", "two", "three"]
    assert texts('<p class="x"hidden>no<p HIDDEN=hidden>no<p style="color:red; Display : none">no<p aria-hidden=true>shown<p>yes') == ["shown", "yes"]
