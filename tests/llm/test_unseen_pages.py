"""Pages unlike those that the model is trained on."""

from __future__ import annotations

import pytest

from stayscope.llm import html_extraction

LONG = "The article has a long text that goes on for a while, with commas, and more than that."
SAID = "I think that this is a comment of some length, and not an article."
LINKS = "<a href='/'>Home</a> <a href='/2'>Two</a>"
CASES = {
    "no markup": ("Just some plain text,\n with a &lt; in it.", "Just some plain text, with a < in it."),
    "no markup, but inline": ("<b>Plain</b> text with <i>marks</i>.", "Plain text with marks."),
    "blank": (" \n ", ""),
    "menu of an unseen name": (f"<body><div class='qwertz'>{LINKS}</div><article><p>{LONG}</p></article></body>", LONG),
    "comments within the article": (f"<body><article><p>{LONG}</p><div class='comments'><div class='comment'><p>{SAID}</p></div></div></article></body>", LONG),
}


@pytest.fixture(scope="module")
def texts(spark):
    pages = spark.createDataFrame([(i, name, html) for i, (name, (html, _)) in enumerate(CASES.items())], "page_id long, url string, html string")
    return {r["row"]["url"]: r["text"] for r in html_extraction.extract(pages).collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_text_of_an_unseen_page(texts, name):
    assert texts[name] == CASES[name][1]


def test_the_sample_takes_one_page_of_each_hash(spark, monkeypatch):
    """However often a page is repeated, the sample stays bounded."""
    rows = [(1, "u", f"<body><article><p>{LONG}</p></article></body>")] * 500 + [(2, "v", f"<body><main><p>{SAID}</p></main></body>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    once = html_extraction.fit(pages.dropDuplicates(), 10)
    many = html_extraction.fit(pages, 10)
    assert once.own == many.own
    assert once.pair == many.pair
