"""Every operator beside columns of odd names: the same result as without them."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stayscope.llm import ann, bpe, html_extraction, line_dedup, near_dedup, packing, quality, substring_dedup, topk, url_filter

ODD = ["1 AS `my col`", "2 AS `a.b`", "'x' AS `{}`", "3 AS `row`", "4 AS `select`"]
PASSAGE = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, f"first line\nsecond line\n{PASSAGE}", "en", "s", 9),
    (2, f"other words\nfirst line\nsecond line\n{PASSAGE} end", "en", "s", 9),
    (3, "alone", "fr", None, 5),
    (None, None, None, None, None),
]
PAGES = [(1, "http://a.org/en/1", "<html><body><article><p>one two three</p></article></body></html>"), (2, None, None)]
VECTORS = [(i, [float(i % 7), 1.0, float(i)]) for i in range(30)]


def documents(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long"), "TEXT"


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string"), "HTML"


def vectors(spark):
    return spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>"), "EMBEDDING"


def classified(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    return quality.classify(docs, labels)


OPERATORS = {
    "packing": (documents, lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json"))),
    "line copies": (documents, line_dedup.remove_copies),
    "line dedup": (documents, line_dedup.line_dedup),
    "url filter": (pages, url_filter.filter_urls),
    "repeats": (documents, substring_dedup.remove_repeats),
    "substring dedup": (documents, substring_dedup.substring_dedup),
    "html": (pages, html_extraction.extract),
    "top k": (vectors, lambda v: topk.exact_topk(v, F.col("id") % 10 == 0)),
    "nearest": (vectors, lambda v: ann.nearest(v, F.col("id") % 10 == 0)),
    "near duplicates": (documents, near_dedup.near_duplicates),
    "near dedup": (documents, near_dedup.near_dedup),
    "bpe": (documents, lambda d: bpe.encode(d, public_tokenizers.path("byte_bpe_50k.json"))),
    "quality": (documents, classified),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_same_result_beside_odd_columns(spark, name):
    table, operator = OPERATORS[name]
    plain, clash = table(spark)
    odd = plain.selectExpr("*", *(c.format(clash) for c in ODD))
    wanted, found = operator(plain), operator(odd)
    extra = {"my col": 1, "a.b": 2, clash: "x", "row": 3, "select": 4}
    rows = []
    for r in found.collect():
        values = dict(zip(found.columns, r, strict=True))
        if "row" in wanted.columns:
            own = dict(zip(values["row"].__fields__, values["row"], strict=True))
            assert {k: own.pop(k) for k in extra} == extra
            values["row"] = own
        elif set(extra) <= set(values):
            assert {k: values.pop(k) for k in extra} == extra
        rows.append(values)
    plain_rows = [{**r.asDict(), **({"row": r["row"].asDict()} if "row" in wanted.columns else {})} for r in wanted.collect()]
    key = lambda rows: sorted(repr(sorted(r.items(), key=str)) for r in rows)
    assert key(rows) == key(plain_rows)
