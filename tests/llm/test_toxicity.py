"""Multiple-instance learning: its loss by finite differences, its scores by plain code, held-out rows, odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from stayscope.llm import toxicity
from stayscope.llm.queries import op11_toxicity

PLAIN = "alpha beta gamma delta omega kappa sigma lambda theta zeta".split()


def sentence(rnd, bad):
    words = [rnd.choice(PLAIN) for _ in range(rnd.randint(3, 9))]
    if bad:
        words[rnd.randrange(len(words))] = rnd.choice(["rotten", "rottener", "vile"])
    return " ".join(words) + rnd.choice([".", "!", "\n"])


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    texts, labels = [], []
    for i in range(400):
        n, bad = rnd.randint(1, 12), i % 5 == 0
        at = rnd.randrange(n)
        texts.append((i, " ".join(sentence(rnd, bad and j == at) for j in range(n))))
        labels.append((i, int(bad)))
    return texts, labels


@pytest.fixture(scope="module")
def model(spark, corpus):
    texts, labels = corpus
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return toxicity.fit(docs, spark.createDataFrame(labels[:300], "doc_id long, toxic int"))


def scored(spark, model, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").transform(lambda d: toxicity.score(d, model)).collect()


def test_held_out_documents_and_offending_sentences(spark, corpus, model):
    texts, labels = corpus
    rows = {r["doc_id"]: r for r in scored(spark, model, texts[300:])}
    assert all((rows[i]["score"] >= toxicity.THRESHOLD) == bool(y) for i, y in labels[300:])
    for i, text in texts[300:]:
        spans = [text[s["from"] : s["to"]] for s in rows[i]["offences"]]
        assert len(spans) == labels[i][1]
        assert all(re.search("rotten|vile", s) for s in spans)


def test_scores_are_noisy_or_of_sentences(spark, corpus, model):
    values = {v: w for v, w in zip(model.values.tolist(), model.weights.tolist(), strict=True)}
    powers = toxicity.mix(np.arange(1, 40, dtype=np.uint64) * toxicity._WHOLE) | np.uint64(1)

    def value(word, n, salt):
        total = sum(int(toxicity.BYTE[b]) * int(powers[j]) for j, b in enumerate(word[:n])) + salt
        return int(toxicity.mix(np.array([total % 2**64], np.uint64))[0])

    def probability(words):
        z = model.bias
        for word in set(words):
            z += values.get(value(word, len(word), len(word) + int(toxicity._WHOLE)), 0)
            z += sum(values.get(value(word, k, k), 0) for k in toxicity.BEGINNINGS if len(word) > k)
        return 1 / (1 + np.exp(-z))

    texts = corpus[0][:40]
    for row in scored(spark, model, texts):
        words = [re.findall(rb"[a-z0-9]+", s.lower()) for s in re.split(rb"[.!?\n]", texts[row["doc_id"]][1].encode())]
        clean = np.prod([1 - probability(w) for w in words if w])
        assert row["score"] == pytest.approx(1 - clean, abs=1e-9)


def test_gradient(model):
    rnd = np.random.default_rng(1)
    bags = [(int(i % 3 == 0), i % 4, np.array([2, 1][: 1 + i % 2]), rnd.integers(0, 6, 2 + i % 2)) for i in range(20)]
    weights = rnd.normal(size=7)
    _, grad = toxicity.loss(bags, weights)
    for j in range(7):
        step = np.eye(7)[j] * 1e-6
        slope = (toxicity.loss(bags, weights + step)[0] - toxicity.loss(bags, weights - step)[0]) / 2e-6
        assert grad[j] == pytest.approx(slope, rel=1e-4, abs=1e-6)


def test_minimum_of_a_parabola():
    scale = np.array([1.0, 10.0, 0.1])
    found = toxicity.minimize(lambda x: (float(scale @ (x - 3) ** 2), 2 * scale * (x - 3)), np.zeros(3), 100)
    assert found == pytest.approx([3, 3, 3], abs=1e-2)


def test_odd_rows(spark, model):
    long = "alpha beta " * 50_000 + "you rotten vile é" + " gamma" * 10_000
    texts = [(1, None), (2, ""), (3, " \n.!"), (4, long), (4, long), (None, "vile rotten é"), (6, "É vile, rotten.")]
    rows = scored(spark, model, texts)
    assert len(rows) == len(texts)
    assert all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["score"] == by[2]["score"] == by[3]["score"] < toxicity.THRESHOLD and by[1]["offences"] == []
    assert all("rotten" in long[s["from"] : s["to"]] for s in by[4]["offences"]) and len(by[4]["offences"]) == 1
    assert by[None]["score"] > toxicity.THRESHOLD
    assert [(s["from"], s["to"]) for s in by[6]["offences"]] == [(0, 14)]


def test_without_labels_of_both_kinds(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string")
    for labels in ([], [(1, 1), (2, 1)], [(1, 0)], [(9999, 1), (None, 0), (3, None)]):
        found = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r["score"] for r in toxicity.score(docs, found).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), found).collect() == []


def test_columns_of_any_name(spark, corpus, model):
    docs = spark.createDataFrame(corpus[0][:9], "doc_id long, text string")
    more = docs.selectExpr("*", "1 AS `my col`", "2 AS `a.b`", "'vile' AS `TEXT`", "3 AS `row`", "4 AS `score`")
    assert sorted(toxicity.score(more, model).collect()) == sorted(toxicity.score(docs, model).collect())


def test_query_never_learns_from_held_out_rows(spark, sf_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    whole = op11_toxicity(spark, str(tmp_path))
    rows = whole.collect()
    assert whole.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    turned = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality", "if(crc32(string(doc_id)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    turned.write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    assert sorted(op11_toxicity(spark, str(tmp_path)).collect()) == sorted(rows)
