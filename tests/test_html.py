"""The extraction helper and the cleaning functions."""

import json

from pyspark.sql import functions as F

from newsloom.operators.extract import _article_parts, _listing_items, clean, html_to_text, sanitize_html
from newsloom.operators.html import Page, compile_selector

DOC = """<div id="top" class="a b"><P class=x>one</P><ul><li class="item">1<b>bold</b></li><li>2</li></ul>
<section class="a"><p>two<br>three</p></section></div><p class="x y">four</p>"""


def texts(selector, css=False, doc=DOC):
    page = Page(doc)
    return [page.text(e) for e in page.select(selector, css=css)]


def test_selectors():
    assert texts("p") == ["one", "two three", "four"]
    assert texts("P.x") == ["one", "four"]
    assert texts(".x.y") == ["four"]
    assert texts("#top p") == ["one", "two three"]
    assert texts("div.a.b .item b") == ["bold"]
    assert texts("DIV section p") == ["two three"]
    assert texts(".A") == [] and texts("#Top") == []
    assert texts("") == [] and texts("p q") == []
    assert texts("div > p") == []  # the plain language has no combinators
    assert compile_selector("  ") == ()


def test_css_selectors():
    assert texts("#top > p", css=True) == ["one"]
    assert texts("section > p, .y", css=True) == ["two three", "four"]
    assert texts("div > * > p", css=True) == ["two three"]
    meta = '<meta property="og:title" content="T"><meta name=x><a href="u">l</a>'
    page = Page(meta)
    assert page.first('meta[property="og:title"]', css=True).attrs["content"] == "T"
    assert page.first("a[href=u]", css=True) and page.first("[name]", css=True).tag == "meta"
    assert page.first("a[href='v']", css=True) is None


def test_descendant_chain_looks_past_inner_matches():
    doc = '<div class="a"><div class="b"><div class="a"><i>x</i></div></div></div><i>y</i>'
    assert texts(".a .b .a i", doc=doc) == ["x"]
    assert texts(".b .a .b i", doc=doc) == []


def test_inner_select_may_use_outer_ancestors():
    page = Page('<ul class="l"><li class="i"><a>1</a></li></ul><a>2</a>')
    item = page.first("li")
    assert [page.text(e) for e in page.select("ul a", item)] == ["1"]
    assert page.select("li", item) == []


def test_void_and_unclosed_elements():
    page = Page("<p>a<br>b<img src=x>c</p><p>d")
    assert page.html() == '<p>a<br>b<img src="x">c</p><p>d</p>'
    assert [page.text(e) for e in page.select("p")] == ["a b c", "d"]
    assert Page("<b>x</i></b>y").html() == "<b>x</b>y"
    assert Page("<i/>x<br/>").html() == "<i></i>x<br>"


def test_serialized_text_is_escaped_but_scripts_are_not():
    assert Page("&lt;b&gt; &amp; <i title='\"'>x</i>").html() == '&lt;b&gt; &amp; <i title="&quot;">x</i>'
    assert Page("<script>a < b && c</script>").html() == "<script>a < b && c</script>"


def test_deep_nesting_and_broken_markup():
    deep = "<div>" * 20000 + "x"
    assert Page(deep).text() == "x"
    for text in ("", "<", "<!", "<![if", "<!DOCTYPE", "<a href='", "&#xZ;", "<p <b>x", "</", "<!-- x"):
        Page(text)


def test_listing_items():
    html = '<ul><li><a href=" /x "> T <b>t</b></a><h2>H</h2><p class="s">S</p></li><li>none</li><li><a>no href</a></li></ul>'
    options = {"item_selector": "li", "title_selector": "h2", "summary_selector": ".s", "keep_content": True,
               "metadata_selectors": {"h": "h2", "all": {"selector": "p,", "all": True}, "raw": {"selector": "b", "attr": "html"},
                                      "cls": {"selector": "p", "attr": "class"}, "gone": {"selector": "p", "attr": "id"}, "no": ""}}
    items = _listing_items(html, json.dumps(options))
    assert [i["href"] for i in items] == ["/x", "", ""]
    first = items[0]
    assert first["link_text"] == "T  t" and first["title_text"] == "H" and first["summary_html"] == '<p class="s">S</p>'
    assert first["meta"] == {"h": "H", "raw": "<b>t</b>", "cls": "s"}
    assert first["content"].startswith('<li><a href=" /x ">')
    own = _listing_items('<a class="i" data-u="/y">z</a>', json.dumps({"item_selector": ".i", "link_selector": "", "url_attribute": "data-u"}))
    assert (own[0]["href"], own[0]["link_text"]) == ("/y", "z")


def test_metadata_lists_keep_blank_but_not_missing():
    html = '<body><i k="1"></i><i></i><i k="">t</i></body>'
    options = {"body_selector": "body", "metadata_selectors": {"k": {"selector": "i", "attr": "k", "all": True}, "t": {"selector": "i", "all": True}}}
    parts = _article_parts(html, json.dumps(options))
    assert parts["lists"] == {"k": ["1", ""], "t": ["", "", "t"]}
    assert _article_parts("<p>x</p>", json.dumps({"body_selector": ".none"})) is None


def test_clean_functions(spark):
    rows = [
        ("<ul><li>um</li><li><em>dois</em><script>x=1</script></li></ul>", "um dois", "<ul><li>um</li><li><em>dois</em></li></ul>"),
        ("<style>p{}</style><h1>a</h1><p class='x'>b , c</p>", "a b, c", "a<p>b , c</p>"),
        ("plain  text ;", "plain text;", "plain  text ;"),
        ("a &lt;b&gt;&nbsp;c", "a <b> c", "a &lt;b&gt; c"),
        ("<a href=' javascript:x' title='t'>l</a><a href='/ok' rel=x>m</a>", "l m", '<a title="t">l</a><a href="/ok">m</a>'),
        ("<span><span><p>x</p></span></span>", "x", "<p>x</p>"),
        ("", "", ""),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, h string")
    got = df.select("i", html_to_text(F.col("h")).alias("t"), sanitize_html(F.col("h")).alias("s")).orderBy("i").collect()
    assert [(r.t, r.s) for r in got] == [(r[1], r[2]) for r in rows]
    own = df.limit(1).select(clean(F.lit("<p><b>x</b></p>"), ("b",))["safe_html"].alias("s")).first()
    assert own.s == "<b>x</b>"
