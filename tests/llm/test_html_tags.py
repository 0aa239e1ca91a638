"""Tags with quoted values, article rules, time on broken pages, odd tables."""

import time

import pytest
from riskloom.llm.html_extract import extract, extract_pages

LONG = "<p>" + "long text here " * 10 + "</p>"
PAGE = f"<article><h1>Title</h1>{LONG}%s{LONG}</article>"


def between(markup):
    lines = extract(PAGE % markup).split("\n")
    assert lines[0] == "Title" and lines[1] == lines[-1]
    return lines[2:-1]


@pytest.mark.parametrize(
    ("markup", "want"),
    [
        ('<p title="a > b" class="x">one two</p>', ["one two"]),
        ("<p title='a > b'>one</p>", ["one"]),
        ('<p>see <img alt="x -> y" src="z.png"> it</p>', ["see it"]),
        ('<p title = "it\'s > 2">one</p>', ["one"]),
        ("<p title=it's>one</p><p title=x'>two</p>", ["one", "two"]),
        ('<section class="related-work"><h2>Related work</h2><p>prior art</p></section>', ["Related work", "prior art"]),
        ('<div class="related"><p>elsewhere</p></div>', []),
        ('<p><a href="x">a paragraph that is one link</a></p>', ["a paragraph that is one link"]),
        ("<ul><li><a href=a>one</a></li><li><a href=b>two</a></li></ul>", []),
        ("<div><a href=a>one</a> <a href=b>two</a></div>", []),
        ("<figure><table><tr><td>cell</td></tr></table><figcaption>c</figcaption></figure>", ["cell"]),
        ("<!-- a > b --><p>1 < 2 and 3 > 2</p><!-- x", ["1 < 2 and 3 > 2"]),
    ],
)
def test_markup_never_becomes_text(markup, want):
    if markup.endswith("<!-- x"):
        assert extract(PAGE.replace("%s", markup.removesuffix("<!-- x")) + "<!-- x").split("\n")[2:-1] == want
    else:
        assert between(markup) == want


def test_header_with_the_title_belongs_to_the_article():
    body = "<p>" + "text of it " * 20 + "</p>"
    assert extract(f"<article><header><h1>My title</h1></header>{body}</article>").startswith("My title\n")
    assert "menu" not in extract(f"<article><header><p>menu</p></header><h1>T</h1>{body}</article>")
    assert "Site" not in extract(f"<header><h1>Site</h1></header><article><h1>T</h1>{body}</article>")


def test_quotes_that_never_end_do_not_hide_the_page():
    assert "the text" in extract('<p title="x>the text of a page whose quote never ends</p>')


@pytest.mark.parametrize("piece", ['<p title="a ', "<p a='", "<b ", "<header>", '<a x="y" ', "<!-- ", "<", "<p a=\"'>", "<script>", "</"])
def test_time_grows_with_the_page(piece):
    extract("x" * 100 + piece * 1000)
    begun = time.perf_counter()
    extract("x" * 100 + piece * 60_000)
    assert time.perf_counter() - begun < 5


def test_odd_tables(spark):
    page = PAGE % "<p>middle</p>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "v", page), (4, "w", page * 300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_pages(df.selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS title"))
    found = sorted((r.page_id or 0, r.url, r.n_chars, r.text.count("middle")) for r in got.collect() if r.url)
    assert [f[3] for f in found] == [1, 0, 1, 1, 300]
    assert {r.page_id: r.text for r in got.collect()}[2] == ""
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert extract_pages(df.limit(0)).count() == 0
