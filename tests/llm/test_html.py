import time

import pytest

from strata.llm.html_text import extract_text, render
from strata.llm.queries import op4_html, table

CASES = [
    ("<p>One <b>two</b>\n three<p>four<br>five", "One two three\n\nfour\nfive"),
    ("<ul><li>a<li>b<ol start=3><li>x<li value=7>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  7. y\n- c"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>10</table>", "Name   Qty\napple  10"),
    ("<table><td colspan=2>long heading<tr><td>a<td>b</table>", "long heading\na  b"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>z</table>", "a        z\n\nin  ner"),
    ("<pre>a  b\n  c</pre>x", "a  b\n  c\n\nx"),
    ("<head><title>T</title></head><body>a<script>var p='</p>';</script>b<style>x{}</style>", "ab"),
    ("<style>.x,p#y{display:none} em{color:red}</style><i class='w x'>1</i><p id=y>2</p><em>3</em>", "3"),
    ("<div hidden>1</div><div style='VISIBILITY : hidden'>2</div><dialog>3</dialog><div>4</div>", "4"),
    ("<details><summary>S</summary>1</details><details open><summary>T</summary>2</details>", "S\nT\n2"),
    ("2 &lt; 3 &amp; 4 < 5 &copy <!-- gone --> x<?pi?>y", "2 < 3 & 4 < 5 © xy"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q</blockquote><hr>z", "  q\n\n----\n\nz"),
    ("<p>a</div></b>b</p>c</p>", "ab\n\nc"),
    ("<noscript>n</noscript><template>t</template><textarea>k\n k</textarea>", "k\n k"),
    ("<a title='x>y' href=z>link</a><x", "link"),
    ("", ""),
    ("plain", "plain"),
    ("<p> </p><p>\n</p>", ""),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_rendering(page, text):
    assert render(page) == text


@pytest.mark.parametrize(
    "page",
    ["<div>" * 50_000 + "x", "<p>x" * 50_000, "<b>" * 30_000 + "<p>" * 30_000, "<ul><li>" * 2_000 + "x",
     "<table><tr><td>" * 300 + "x", "<a href='" * 50_000, "<" * 100_000, "<!--" * 50_000, "<td>" * 30_000],
)
def test_malformed_and_deep_pages_take_linear_time(page):
    begun = time.time()
    render(page)
    assert time.time() - begun < 20


def test_query_keeps_every_visible_word(spark, sf_dir):
    rows = {r["page_id"]: r for r in op4_html(spark, sf_dir).collect()}
    pages = table(spark, sf_dir, "pages").collect()
    assert len(rows) == len(pages)
    import html
    import re

    for p in pages:
        body = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->", " ", p["html"])
        words = html.unescape(re.sub(r"(?s)<[^>]*>|<[^>]*$", " ", body)).split()
        got = rows[p["page_id"]]
        assert [w for w in got["text"].split() if w != "-"] == words and got["n_chars"] == len(got["text"])


def test_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, "a"), (1, "<p>x", "b"), (1, "<p>x", "b"), (None, "", None), (2, "y" * 300_000, None)],
        "page_id long, html string, text string",
    )
    rows = extract_text(pages).collect()
    assert extract_text(pages).columns == pages.columns
    assert sorted(("NULL" if r["text"] is None else r["text"])[:4] for r in rows) == ["", "NULL", "x", "x", "yyyy"]
    assert extract_text(pages.limit(0)).count() == 0
