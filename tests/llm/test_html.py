"""Main text: pages without prose, hosts that outvote one page, and odd tables."""

import pytest

from quillon.llm.html_extraction import Page, extract_main_text

SCHEMA = "page_id bigint, url string, html string"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><p>Short note without a stop</p></article>", "Short note without a stop"),
        ("<main><table><tr><td>Name</td><td>Age</td></tr><tr><td>Ann</td><td>31</td></tr></table></main>", "Name\nAge\nAnn\n31"),
        ("<nav>menu</nav><div class='content'><p>two words</p></div><div class='sidebar'>no</div>", "two words"),
        ("<main><a href=x>home</a> <a href=y>about us</a></main>", ""),
        ("<div><a href=x>home</a></div>", ""),
    ],
)
def test_pages_without_prose_give_what_an_article_part_holds(html, text):
    page = Page(html)
    assert page.text(page.best(None)) == text


def _page(text: str, blurb: str) -> str:
    links = " ".join(f"<a href='/{i}'>another page of this site {i}</a>" for i in range(60))
    return f"<html><body><div class='links'>{links}</div><div class='text'><p>{text}</p></div><div class='blurb'><p>{blurb}</p></div></body></html>"


def test_a_host_outvotes_the_one_page_whose_own_best_is_something_else(spark):
    long, short = "The story goes on and on for a good while, as stories do. " * 8, "A short blurb closes the page. " * 2
    odd_text, odd_blurb = "This story is a brief one, but it is the story. " * 4, "The blurb of this page runs longer than its story does. " * 5
    pages = [(i, f"https://one.example/{i}", _page(f"Page {i}. {long}", short)) for i in range(9)] + [(9, "https://one.example/9", _page(odd_text, odd_blurb))]
    alone = Page(pages[9][2])
    assert alone.text(alone.best(None)) == odd_blurb.strip()
    found = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert found[9] == odd_text.strip() and found[0].startswith("Page 0.")


def test_tables_with_nothing_repeated_rows_ties_and_long_pages(spark):
    assert extract_main_text(spark.createDataFrame([], SCHEMA)).collect() == []
    paragraph = "<p>A paragraph of ordinary prose that ends with a stop.</p>"
    twin = f"<body><div class='a'>{paragraph}</div><hr><div class='b'>{paragraph}</div></body>"
    rows = [(1, "https://x.example/1", twin, "t"), (1, "https://x.example/1", twin, "t"), (2, None, twin, "t"), (3, "https://x.example/3", None, None), (None, "https://y.example/", f"<article>{paragraph * 4000}</article>", "t")]
    docs = spark.createDataFrame(rows, SCHEMA + ", text string")
    got = extract_main_text(docs.select("page_id", "url", "html")).collect()
    texts = sorted((r.page_id or 0, len(r.text.split("\n"))) for r in got if r.text)
    # both of two equal parts are inside the outermost path of the highest score
    assert texts == [(0, 4000), (1, 2), (1, 2), (2, 2)]
    assert [r.text for r in got if r.page_id == 3] == [""]
