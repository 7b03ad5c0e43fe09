import html as html_library
import re

import pytest

from reelmeter.llm.html_text import extract_text, rendered

CASES = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<p>a <b>bold</b>   word</p>\n <div>x</div><div>y</div>", "a bold word\n\nx\ny"),
    ("<h1>T</h1>text<br>next<hr>end", "T\n\ntext\nnext\n\n---\n\nend"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>after", "- a\n- b\n  - c\n\nafter"),
    ("<ol start=3><li>x</li><li hidden>no</li><li>y</ol>", "3. x\n4. y"),
    ("<table><tr><th>name<th>n<tr><td>long name<td>1</table>", "name      | n\nlong name | 1"),
    ("<table><td>a</td><td colspan=2>b</td><tr><td>c<td>d<td>e</table>", "a | b |\nc | d | e"),
    ("<table><tr><td>漢字<td>x<tr><td>a<td>y</table>", "漢字 | x\na    | y"),
    ("<table><tr><td>two<br>lines<td>z</table>", "two   | z\nlines |"),
    ("<pre>  keep\n   this </pre>", "  keep\n   this"),
    ("<div style='display: none'>no</div><span hidden>no</span><p>yes", "yes"),
    ("<script>if (a < b) '</p>'</script><style>p{}</style><!-- no --><title>no</title>yes", "yes"),
    ("<html><head><title>t</title><body>in body", "in body"),
    ("<p>x</p></div></p>y", "x\n\ny"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\nd1\nd2"),
    ("<p>a<table><tr><td>1</table>b", "a\n\n1\n\nb"),
    ("a < b and <3 and <", "a < b and <3 and <"),
    ("<p", ""),
    ("<!doctype html><body hidden>gone", ""),
    ("<select><option>a<option>b</select><textarea>t</textarea>x", "x"),
    ("<blockquote><p>q</p></blockquote>r", "q\n\nr"),
    ("<a href='x>y'>link</a>", "link"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert rendered(page) == text


def test_deep_and_long():
    assert rendered("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert rendered("<ul><li>" * 300 + "x").endswith("- x")
    assert rendered("<b>" * 3000 + "y<p>z").split() == ["y", "z"]
    assert rendered("<table><tr><td>" * 400 + "x").endswith("x")
    long = "<p>" + "word " * 100_000
    assert rendered(long).count("word") == 100_000


def test_hidden_text_at_any_depth():
    deep = "<div>" * 400
    assert rendered(deep + "<span hidden>no</span>yes") == "yes"
    assert rendered("<div hidden>" + deep + "<div>x</div>no" + "</div>" * 401 + "yes") == "yes"
    assert rendered("<b>" * 5000 + "<pre>" + "<i>" * 5000 + " x") == " x"
    assert rendered("<ul><li>" * 300 + "x") == "- " * 300 + "x"


@pytest.mark.parametrize(
    "page,text",
    [
        ("<svg><rect/><title>no</title><desc>no</desc><text>label</text></svg>y", "labely"),
        ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><tr><td>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<td>e</table>", "a | b |  | c\nd |   |  | e"),
        ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d</table>", "a | b\n  | c\nd"),
    ],
)
def test_shown_and_spanned(page, text):
    assert rendered(page) == text


def _words(page):
    """All words outside of tags, invisible elements gone; enough for pages without hidden parts."""
    page = re.sub(r"(?s)<!--.*?-->|<(script|style|title|head)\b.*?</\1>", " ", page)
    page = re.sub(r"(?s)</?(?:b|i|a|em|strong|span|u|code|sup|sub|small)\b[^>]*>", "", page)
    return html_library.unescape(re.sub(r"(?s)<[^>]+>", " ", page)).split()


def test_all_words_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    found = extract_text(pages.select("page_id", "html"))
    for r in found.collect():
        page = source[r["page_id"]]
        if re.search(r"hidden|display\s*:\s*none|<(select|textarea|noscript|template|svg|iframe|dialog)", page, re.I):
            continue
        got = [w for w in re.sub(r"(?m)^\s*(?:- |\d+\. )+|(?<= )\|(?= |$)|^---$", " ", r["text"]).split()]
        want = [w for w in _words(page) if w != "|"]
        assert sorted(x for x in got if x not in "|-") == sorted(x for x in want if x not in "|-"), r["page_id"]


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, "x", "old"), (2, "", None, None), (2, "<p>a", "y", "z"), (2, "<p>a", "y", "z")], "page_id long, html string, url string, text string")
    got = extract_text(frame)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted((r["page_id"], r["text"]) for r in got.collect()) == [(1, ""), (2, ""), (2, "a"), (2, "a")]
    assert extract_text(frame.where("false")).count() == 0
