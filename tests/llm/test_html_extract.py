import html
import re

import duckdb
import pytest
from pyspark.sql import types as T

from vellum.llm import queries
from vellum.llm.html_extract import Weights, best_run, count_places, extract_pages, main_text, weights_from

from .conftest import SF


def article(page):
    """The text of a page's marked article, by plain cutting."""
    inside = page.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    lines = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_query_finds_the_articles(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    rows = queries.op10_html_extraction(spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == {i: article(h) for i, h in pages.items()}
    assert all(r.n_chars == len(r.text) for r in rows)


def test_held_out_pages_without_their_marks():
    """Weights of some pages find the articles of others that mark nothing."""
    pages = [h for (h,) in duckdb.sql(f"SELECT html FROM '{SF.replace('0.001', '0.01')}/pages.parquet' ORDER BY page_id").fetchall()]
    counts = sum((count_places(h) for h in pages[::2]), type(count_places(""))())
    weights = weights_from(counts)
    good = 0
    for h in pages[1::2]:
        bare = re.sub(r"</?article>", "", h)
        good += main_text(bare, weights) == article(h)
    assert good >= 0.98 * len(pages[1::2])


@pytest.mark.parametrize("scores", [[], [-1], [1, -2, 3, -1, 2, -5, 4], [0, 0, 5], [-1, 2, 2, -9, 4], [3, -3, 3]])
def test_best_run_is_a_best_run(scores):
    best = max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))])
    start, end = best_run(scores)
    assert sum(scores[start:end]) == best


PAGE = """<!doctype html><html><head><title>Not this</title><style>p{}</style><script>if (a < b) { x = "</p>" }</script></head>
<body><header><h2>Site</h2><p>Words about the site</p></header><nav><ul><li><a href="#">Home</a><li><a href="#">News</a></ul></nav>
<div id="cookieNotice">We use cookies, read on</div><main><h1>The  headline &amp; more</h1>
<p>First paragraph with <b>bold</b> words &mdash; and a&nbsp;<a href=x>link</a>.<div class="ad-slot">Buy these things</div>
<p>Second one<br>after a break<!-- not this --><ul><li>An item of the list<li>Another item of it</ul>
<aside>Related: other things to read</aside><form>Your name <input><button>Send</button></form><noscript>No script</noscript>
<p>Third paragraph, the last.</p></main><div class="user comments"><p>I liked this very much, thanks for writing it all down.</p></div>
<footer>&copy; someone</footer></body></html>"""


def test_parts_that_are_not_the_article():
    assert main_text(PAGE, Weights()).split("\n") == [
        "The headline & more", "First paragraph with bold words — and a link.", "Second one after a break",
        "An item of the list", "Another item of it", "Third paragraph, the last."]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("no markup at all here", "no markup at all here"), ("<p>open <b>ended", "open ended"),
    ("<nav><a>only a menu</a></nav>", ""), ("<body><form><p>All in one form, as some pages are</p></form>", "All in one form, as some pages are"),
    ("<p>a&lt;b &#233; &unknown; &am</p>", "a<b é &unknown; &am"), ("<p>x < y and > z</p>", "x < y and > z")])
def test_small_pages(page, text):
    assert main_text(page, Weights()) == text


def test_edge_cases(spark):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("page_id", "html", "text", "page")])
    long = "<article>" + "<p>words in a paragraph</p>" * 30_000 + "</article>"
    rows = extract_pages(spark.createDataFrame([("1", None, "a", "b"), ("2", long, "a", "b"), ("2", long, "a", "b")], schema), Weights())
    got = rows.select("page.page_id", "page.page", "text").collect()
    assert [r.text.count("\n") for r in sorted(got, key=lambda r: r.page_id)] == [0, 29_999, 29_999] and got[0].page == "b"
    assert extract_pages(spark.createDataFrame([], schema), Weights()).collect() == []


PROSE = "This block belongs to the article and holds a good many words of running text, as blocks of articles do."
BODY = f"<h1>The headline</h1><p>{PROSE}</p><p>{PROSE}</p>"
TEXT = f"The headline\n{PROSE}\n{PROSE}"


@pytest.mark.parametrize("mark", ["article", "main", "div"])
@pytest.mark.parametrize("names", ['class="site has-sidebar"', 'class="layout overflow-hidden"', 'id="search-form-page"',
                                   'class="no-comments ad-free"', 'id="widget" class="header"'])
def test_wrappers_with_names_of_other_things(mark, names):
    """A name never takes the article away, with or without a mark."""
    menu, remarks = "<nav><a>Home</a> <a>News</a></nav>", f'<div class="comments"><p>{PROSE}</p></div>'
    for page in (f"<body><div {names}>{menu}<{mark}>{BODY}</{mark}>{remarks}</div></body>",
                 f"<body><div class='page-header'><div {names}>{menu}<{mark}>{BODY}</{mark}></div></div></body>",
                 f"<body><{mark}><div {names}>{BODY}</div></{mark}>{remarks}</body>"):
        assert main_text(page, Weights()) == TEXT


@pytest.mark.parametrize("mark", ["article", "main", "div"])
@pytest.mark.parametrize("block", ['<div class="legal-text">{}</div>', '<section class="share-prices">{}</section>',
                                   '<div id="form-of-government">{}</div>'])
def test_article_blocks_with_names_of_other_things(mark, block):
    for first, last in ((BODY, BODY), (BODY, "")):
        page = f"<body><{mark}>{first}{block.format(PROSE)}{last}</{mark}><footer>Some words of the site</footer></body>"
        assert main_text(page, Weights()).split("\n") == [*TEXT.split("\n"), PROSE, *(TEXT.split("\n") if last else [])]


def test_names_still_speak_against_other_things():
    """Long comments, adverts and link lists beside or in an article."""
    others = (f'<section id="comments">{"".join(f"<article class=comment><p>{PROSE}</p></article>" for _ in range(9))}</section>'
              f'<div class="related-posts">{"<a>Another article to read</a> " * 9}</div><div class="sidebar"><p>{PROSE}</p></div>')
    for mark in ("article", "main", "div"):
        assert main_text(f"<body><{mark}>{BODY}<div class='ad-slot'>{PROSE}</div><p>The end of it.</p></{mark}>{others}</body>",
                         Weights()) == TEXT + "\nThe end of it."
    post = f"<article class='post has-ad'>{BODY}</article>"
    assert main_text(f"<body>{post}{others}</body>", Weights()) == TEXT
