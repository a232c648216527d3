"""The sample of labels that the quality classifier is fitted on."""

from __future__ import annotations

import numpy as np

from stayscope.llm import quality


def test_labels_that_name_no_document_use_up_no_sample(spark):
    rows = [(i, "fine words in a row " * 9 if i % 2 else "### $$$ 7% " * 9, "s", "en") for i in range(40)]
    docs = spark.createDataFrame([*rows, rows[0], (None, "x", "s", "en")], "doc_id long, text string, source string, lang string")
    given = [(i, i % 2) for i in range(40)] + [(0, 1)]
    others = [(i, 1) for i in range(1000, 3000)]
    whole = quality.fit(docs, spark.createDataFrame(given, "doc_id long, quality int"), 40)
    found = quality.fit(docs, spark.createDataFrame([*given, *others], "doc_id long, quality int"), 40)
    assert np.abs(whole.weight).max() > 0
    assert np.allclose(found.weight, whole.weight) and np.isclose(found.bias, whole.bias)
