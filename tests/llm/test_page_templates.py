import pytest

from tests.llm.conftest import words
from tributary.llm import page_templates
from tributary.llm.page_templates import article_of, blocks_of

PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="nav">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="top-ad box">Buy</div><div id=cookie-notice>We use cookies</div>
<article><header><h1>Head &amp; more</h1></header><p><b>First  line<br>goes&nbsp;on <a href=x>here</a><p>Second &lt;p&gt; &copy; &#233;</p>
<ul><li>one<li>two</ul><form><input>Mail<button>Send</button></form><aside>Beside</aside><table><tr><td>a<td>b</table>
<section class="comments"><p>Nice!</p></section>a < b</article><footer>&copy; Site</footer></body></html>"""


def test_an_article_is_extracted():
    assert article_of(PAGE).split("\n") == ["Head & more", "First line goes on here", "Second <p> © é", "one", "two", "a", "b", "a < b"]


@pytest.mark.parametrize("cut", range(0, len(PAGE), 7))
def test_a_page_may_end_anywhere(cut):
    whole, part = article_of(PAGE).replace("\n", ""), article_of(PAGE[:cut]).replace("\n", "")
    tail = 10  # of a half reference or sign at the end
    assert whole.startswith(part[:-tail] if len(part) > tail else "")


def test_blocks_know_their_links():
    assert blocks_of("<ul><li><a>menu</a><li>text <a>x</a></ul>") == [("ul/li", "menu", 4), ("ul/li", "text x", 1)]


def test_templates_leave_slots_where_no_element_tells(spark):
    pages = [(i, f"https://h.example/{i}", f"<div><p>Our site</p><div><p>{words(i, 30)}</p><p>{words(i + 500, 9)}</p></div>"
              f"<ul><li><a href=/x>{words(i + 900, 2)}</a></ul><p>All about us</p></div>") for i in range(20)]
    pages += [(100 + i, f"https://one.example/{i}", f"<p>only {i}</p>") for i in range(1)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in page_templates.extract_articles(table).collect()}
    assert found[100] == "only 0"
    assert all(found[i] == f"{words(i, 30)}\n{words(i + 500, 9)}" for i in range(20))


def test_text_shared_by_articles_stays(spark):
    pages = [(i, "http://h.example", f"<nav>Menu</nav><article><p>Shared line</p><p>{words(i, 5)}</p></article>") for i in range(12)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    for r in page_templates.extract_articles(table).collect():
        assert r.text == f"Shared line\n{words(r.page_id, 5)}" and r.n_chars == len(r.text)


def test_odd_rows(spark):
    long_page = "<article>" + "".join(f"<p>{words(i, 50)}</p>" for i in range(400))
    rows = [(1, None, None), (2, "no address", ""), (3, None, "plain text"), (4, "http://x.y", "<article><p>a"), (4, "http://x.y", "<article><p>a"),
            (None, "http://x.y:80/", "<article>b</article>"), (5, "http://x.y", "<" * 2000), (6, "http://x.y", "</p></div>" * 500), (7, "http://x.y", long_page)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, host int, text int")
    out = page_templates.extract_articles(table)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    found = [(r.page_id, r.text) for r in out.collect()]
    assert len(found) == len(rows) and found.count((4, "a")) == 2
    assert {(1, ""), (2, ""), (3, "plain text"), (None, "b"), (6, "")} <= set(found)
    assert next(t for i, t in found if i == 7).count("\n") == 399
    assert page_templates.extract_articles(table.filter("false")).count() == 0
