"""Every layout that a model of the others has not seen is read without an error."""

from __future__ import annotations

import re

from stayscope.llm import html_extraction
from stayscope.llm.layouts import labelled_pages


def test_every_second_layout():
    found = {}
    for page in labelled_pages()[::2]:
        own = html_extraction.Page(page)
        for k, v in html_extraction.counts(own, own.labels()).items():
            found[k] = found.get(k, 0) + v
    model = html_extraction.Model(found)
    for page in labelled_pages()[1::2]:
        content = re.sub("<y0>.*?</y0>", "", re.search("<y1>(.*)</y1>", page)[1])
        wanted = [" ".join(x.split()) for x in re.split(r"<[^>]*>", content)]
        assert model.text(re.sub("</?y[01]>", "", page)) == "\n".join(x for x in wanted if x)
