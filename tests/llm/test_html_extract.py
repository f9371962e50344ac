"""Main text of pages: planted articles by a plain parser, and hand-made pages."""

import html
import re

import pytest

from respfeat.llm import html_extract as he
from respfeat.llm.common import table

from .conftest import SF_DIR

P = "Some words of an article, and some more of them, until there is a sentence of some length. "


def planted(page):
    """The blocks of the article in a page of the test tables, which nest nothing."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = table(spark, SF_DIR, "pages")
    want = sorted((r["page_id"], r["url"], planted(r["html"]), len(planted(r["html"]))) for r in pages.collect())
    got = he.query(spark, SF_DIR)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), ("plain text", "plain text"), ("<p>", ""), ("a < b &lt;i&gt; &amp;amp; c&#233;&nbsp; d", "a < b <i> &amp; cé d"),
    ("<body>one<script>var a = '<p>no</p>'</script> line<style>p{}</style><!-- <p>no --> here", "one line here"),
    ("<p>never closed <b>bold<p>next<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><th>3</table>end", "never closed bold\n\nnext\n\na\n\nb\n\n1 2\n\n3\n\nend"),
    ("<p>kept <span class=ad>bought</span>line<span hidden>x</p><p>next", "kept line\n\nnext"),
    ("<p>text<!-- open comment <p>gone", "text"), ("<p>text<script>open", "text"), ("<p title='a>b'>x</p><p title=\"open>y", "x\n\ny"),
    ("<article><header><h1>T</h1></header><p>x</p><aside>no</aside><footer>no</footer></article><header>site</header>", "T\n\nx"),
    ("<main><p>x</p><form><input><p>no</form></main><nav><p>no</nav>", "x"),
    ("<form>" + f"<div><p>{P}</p></div>" * 3 + "</form>", "\n\n".join([P.strip()] * 3)),
    ("<div class='layout has-sidebar'><p>x</p></div>", "x"),
    ("<div class=sidebar-layout><main><p>x</p></main><div id=sidebar>no</div></div>", "x"),
    (f"<article><p>{P}</p><section class=comments><article><p>{P * 3}</article></section><article>reply</article></article>", P.strip()),
    ("<article><p>x</p><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul></article>", "x"),
    ("<article><p>see <a href=1>one</a> and <a href=2>two</a> and <a href=3>three</a>, which are more than links</article>",
     "see one and two and three, which are more than links"),
])
def test_pages(page, want):
    assert he.main_text(page) == want


def test_scores_choose_among_plain_containers():
    links = "".join(f'<div><a href="{k}">Go to page number {k} of this site, please</a></div>' for k in range(30))
    page = (
        f"<body><div>{links}</div><div><h1>Title</h1><div class=x1>{f'<p>{P}</p>' * 4}</div><div class=x2>{f'<p>{P}</p>' * 3}</div>"
        f"<div class='cookie-notice'><p>{P * 2}</p></div><div>Short.</div></div><div>All rights, reserved.</div>"
    )
    text = he.main_text(page)
    assert text.split("\n\n")[0] == "Title" and text.count(P.strip()) == 7
    assert "Go to" not in text and "rights" not in text


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + P + "</div>" * 30_000
    assert he.main_text(deep) == P.strip()
    assert he.main_text("<b>" * 50_000 + "x") == "x"
    long = f"<article>{f'<p>{P}' * 20_000}</article>"
    assert len(he.main_text(long)) == 20_000 * (len(P.strip()) + 2) - 2


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    pages = spark.createDataFrame([(None, None, None, "t", 1), (1, "u", "", None, None), (1, "u", "<p>😀é", "t", 1), (1, "u", "<p>😀é", "t", 1)], schema)
    assert sorted(map(tuple, he.extract(pages).collect()), key=repr) == sorted([(None, None, "", 0), (1, "u", "", 0), (1, "u", "😀é", 2), (1, "u", "😀é", 2)], key=repr)
    assert he.extract(pages.limit(0)).count() == 0
