import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from topiclake.llm.html_text import extracted, op4_html_text, text_of

CASES = [
    (None, ""), ("", ""), ("plain & simple", "plain & simple"), ("a &lt;b&gt; &eacute; &#8364;", "a <b> é €"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>one</div><div>two</div>", "one\ntwo"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<title>no</title>yes", "yes"), ("<head><title>x</title></head><body>y</body>", "y"),
    ("<script>var a='</p>';</script>x<style>p{}</style>", "x"), ("<!-- no -->x<!--> y -->", "x y -->"),
    ("<p hidden>no</p><p style='color:red; display : none'>no</p>yes", "yes"),
    ("<style>.ad, #x{display:none} p.q{display:none}</style><div class='b ad'>n</div><p id=x>n</p><p class=q>n</p><b class=q>y</b>", "y"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
    ("<style>@media print { .m { display:none } } @import 'x'; .n{display:none}</style><p class=m>y</p><p class=n>no</p>", "y"),
    ("<style>@media screen, print { .m { display:none } } .k{x:y}</style><p class=m>no</p>y", "y"),
    ("<style>@media (max-width:9px) { .m { display:none } @supports (a:b) { p{display:none} } } .n{display:none}</style><p class=m>y<p class=n>no", "y"),
    ("<style media=print>p{display:none}</style><p>y", "y"), ("<style>.x{display:none} .x{display:block}</style><p class=x>y", "y"),
    ("<style>#a{display:block} .x{display:none} p{display:none}</style><p class=x id=a>y<p class=x>no", "y"),
    ("<style>.x{display:none !important} #a{display:block}</style><p class=x id=a style='display:block'>no</p>y", "y"),
    ("<style>.v{visibility:hidden} b{visibility:visible}</style><p class=v>no<b>yes</b></p>", "yes"),
    ("<style>.a .b{display:none}</style><div class=a><p><i class=b>no</i>y</p></div><i class=b>z</i>", "y\n\nz"),
    ("<style>.a > .b{display:none} p.q.r{display:none}</style><div class=a><i class=b>no</i><p class='r q'>no</p><u><i class=b>y</i></u></div><p class=q>z", "y\n\nz"),
    ("<style>.x{display:none}</style><p class=x style='display:block'>y", "y"), ("<style>a:hover{display:none} p{display:none</style><a>y</a><p>no", "y"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "* a\n* b\n  * c\n* d\n\ne"),
    ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"), ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<ul><li><p>a</p><p>b</p></li></ul>", "* a\n\n  b"),
    ("<table><tr><th>Name<th>N<tr><td>apple<td>1<tr><td>fig<td>22</table>", "Name   N\napple  1\nfig    22"),
    ("<table><caption>C</caption><tr><td colspan=2>wide cell here<td>x<tr><td>a<td>b<td>c</table>", "C\nwide cell here  x\na  b  c"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td>a<br>aa<td>b</table>", "a   b\naa"), ("<table><tr><td><table><tr><td>x<td>y</table><td>z</table>", "x  y  z"),
    ("<pre>a\n  b   c</pre>d", "a\n  b   c\n\nd"), ("x  \n y <b> z</b>w", "x y zw"), ("<i>a </i> <b> b</b>", "a b"),
    ("<h1>T</h1>text<h2>U", "T\n\ntext\n\nU"), ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    ("<blockquote>q<br>r</blockquote>", "  q\n  r"), ("<p>a</div>b</p>", "ab"), ("a</p>b", "a\n\nb"), ("3 < 4 and 5 > 2", "3 < 4 and 5 > 2"),
    ("<p title='a>b'>x</p>", "x"), ("<p title=it's>x</p>", "x"), ("x<a href='never ends", "x"), ("<textarea>\n a\n b</textarea>", " a\n b"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
    ("<select><option>a<option selected>b</select>", "b"), ("<input value=v><input type=hidden value=h>", "v"), ("</br>x", "x"),
    ("<noscript>n</noscript>y<template>t</template>", "y"), ("<table><tr><td>a</table>b", "a\n\nb"), ("<td>loose</td> cell", "loose cell"),
]


@pytest.mark.parametrize("html,want", CASES)
def test_layout(html, want):
    assert text_of(html) == want


def test_hostile_pages_end_soon():
    assert text_of("<div>" * 50_000 + "x") == "x"
    assert text_of("<table><tr><td>" * 3000 + "x").strip() == "x"
    assert text_of("<style>" + ".a div i, .b > div p {display:none}" * 20 + "</style>" + "<div class=a>" * 50_000 + "x") == "x"
    assert text_of("<style>" + "@media print {" * 20_000 + "p{display:none}" + "</style><p>x") == "x"
    assert text_of("<b>" * 20_000 + "<p>y" * 2000).count("y") == 2000
    assert text_of("<" * 100_000) == "<" * 100_000
    assert text_of("<a '" * 50_000) == ""
    assert len(text_of("<ul><li>" * 500 + "x")) < 5000
    cell = "w" * 1_000_000
    assert len(text_of("<table>" + "<tr><td>a<td>b" * 1000 + f"<tr><td>{cell}<td>z</table>")) < 1_200_000


def test_all_text_of_the_body_is_there(spark):
    rows = op4_html_text(spark, "/root/testdata/sf0.01").collect()
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        body = re.sub(r"(?s)^.*?<body>|<!--.*?-->|<(script|style).*?</\1>", "", pages[r.page_id])
        want = unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert sorted(w for w in r.text.split() if w != "*") == sorted(w for w in want if w != "*"), r.page_id


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>x"), (3, "<p>x"), (3, "<p>x"), (4, "<script>"), (5, "<p>word</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit(1), "n_lines": F.lit("a")})
    got = sorted((r.page_id or 0, len(r.text), r.n_lines) for r in extracted(pages).collect())
    assert got == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 1, 1), (3, 1, 1), (4, 0, 0), (5, 20_000 * 6 - 2, 39_999)]
    assert extracted(pages.limit(0)).count() == 0
