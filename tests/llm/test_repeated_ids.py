"""Rows that repeat an id are candidates like any others."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from stayscope.llm import ann, topk


def test_no_row_is_lost_by_its_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [5.0, 0.0]), (2, [3.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = topk.exact_topk(vectors, F.col("id") == 0, 3, 1).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(exact, key=lambda r: r["rank"])] == [(1, 5), (2, 3), (1, 1)]
    near = ann.nearest(vectors, F.col("id") == 0, 3).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(near, key=lambda r: r["rank"])] == [(1, 5.0), (2, 3.0)]


def test_exact_search_over_repeated_rows_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(40), [float(rnd.randint(-4, 4)) for _ in range(3)]) for _ in range(120)]
    vectors = spark.createDataFrame(rows + rows[:30], "vec_id long, embedding array<double>")
    rows = [(i, list(v)) for i, v in {(i, tuple(v)) for i, v in rows}]
    found = topk.exact_topk(vectors, F.col("id") % 4 == 0, 5, 1).collect()
    wanted = []
    for q in {i for i, _ in rows if i % 4 == 0}:
        scored = [(-sum(int(a * b) for a, b in zip(x, y, strict=True)), j) for i, x in rows if i == q for j, y in rows if j != q]
        wanted += [(q, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:5], 1)]
    assert sorted(tuple(r) for r in found) == sorted(wanted)
