"""Nearest neighbours of queries whose first buckets are empty."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from stayscope.llm import ann


def test_sparse_queries_meet_every_vector(spark, monkeypatch):
    """With as many functions as a table of 10**8 vectors has, and norms that put all data far from the queries."""
    x = np.random.default_rng(8).standard_normal((400, 8))
    x[7] *= 1000
    monkeypatch.setattr(ann, "BUCKET", 400 / 4**9)
    monkeypatch.setattr(ann, "PART", 50)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(3, [float(v) for v in x[3]]), (1000, [1.0, 2.0]), (1001, [3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(frame, F.col("id") % 100 == 0).collect()}
    wanted = {(1000, 1): (1001, 5.0)}
    for q in range(0, 400, 100):
        score = x @ x[q]
        best = [int(i) for i in np.argsort(-score) if i != q][:20]
        wanted |= {(q, r + 1): (i, score[i]) for r, i in enumerate(best)}
    assert {k: i for k, (i, _) in found.items()} == {k: i for k, (i, _) in wanted.items()}
    assert all(abs(found[k][1] - s) < 1e-9 * max(1, abs(s)) for k, (_, s) in wanted.items())
