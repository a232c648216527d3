"""The classifier's words, pooling and scores against plain code."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stayscope.llm import quality
from stayscope.llm.words import Words

GOOD = "river stone window garden letter morning table winter paper music".split()
BAD = "click casino winner bonus prize offer".split()


def corpus(n=240):
    rnd = random.Random(11)
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = [rnd.choice(GOOD) for _ in range(rnd.randint(5, 30))]
        if bad:  # of the same shape, told apart by words alone
            words = [rnd.choice(BAD) if rnd.random() < 0.5 else w for w in words]
        host = rnd.choice(["big", "big", "big", "small", None])
        path = rnd.choice(["a", "b", None])
        docs.append((i, " ".join(words), host, path))
        labels.append((i, int(not bad)))
    return [*docs, (1000, None, "rare", "a"), (1001, "", None, None), (None, "river casino", "big", "a")], labels


@pytest.fixture(scope="module")
def found(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    known = spark.createDataFrame(labels[::2], "doc_id long, quality int")
    model = quality.fit(frame, known)
    rows = quality.classify(frame, known).collect()
    return docs, labels, model, rows


def value_of(word):
    return int(Words([word.encode()]).value[0])


def test_words_by_the_g_test(found):
    docs, labels, model, _ = found
    texts = {i: set(t.split()) for i, t, _, _ in docs if t}
    kind = dict(labels[::2])
    good, bad = (sum(1 for y in kind.values() if y == k) for k in (1, 0))
    seen = defaultdict(Counter)
    for i, y in kind.items():
        for w in texts[i]:
            seen[w][y] += 1
    wanted = {}
    for w, c in seen.items():
        table = [(c[1], good), (c[0], bad)]
        share = (c[1] + c[0]) / (good + bad)
        g = 2 * sum(x * math.log(x / (t * s)) for k, t in table for x, s in ((k, share), (t - k, 1 - share)) if x)
        if g >= quality.LEAST_G:
            wanted[value_of(w)] = math.log((c[1] + 0.5) / (good + 1)) - math.log((c[0] + 0.5) / (bad + 1))
    assert wanted
    assert dict(zip(model.content.values.tolist(), model.content.odds.tolist(), strict=True)) == pytest.approx(wanted)


def plain_evidence(model, text):
    known = dict(zip(model.content.values.tolist(), model.content.odds.tolist(), strict=True))
    words = {value_of(w) for w in text.split()}
    content = sum(known.get(w, 0.0) for w in words) / math.sqrt(max(1, len(words)))
    shape = quality.described([text.encode()])[0][0]
    z = np.clip((np.append(shape, content) - model.mean) / model.scale, -8, 8)
    return float(z @ model.weight + model.bias)


def strength(groups, parent):
    n = sum(g[0] for g in groups)
    spread = sum(g[0] * (g[1] / g[0] - p) ** 2 for g, p in zip(groups, parent, strict=True))
    noise = sum(p * (1 - p) for p in parent)
    level = sum(g[0] * p * (1 - p) for g, p in zip(groups, parent, strict=True))
    return max(1.0, level / n / max((spread - noise) / n, 1e-6) - 1)


def test_evidence_pooling_and_score(found):
    docs, _, model, rows = found
    evidence = [plain_evidence(model, t or "") for _, t, _, _ in docs]
    posterior = [1 / (1 + math.exp(-e)) for e in evidence]
    paths, hosts = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for (_, _, host, path), p in zip(docs, posterior, strict=True):
        for group in (paths[host, path], hosts[host]):
            group[0] += 1
            group[1] += p
    overall = (sum(posterior) + 0.5) / (len(docs) + 1)
    k = strength(list(hosts.values()), [overall] * len(hosts))
    host_rate = {h: (s + k * overall) / (n + k) for h, (n, s) in hosts.items()}
    k = strength(list(paths.values()), [host_rate[h] for h, _ in paths])
    rate = {(h, p): (s + k * host_rate[h]) / (n + k) for (h, p), (n, s) in paths.items()}
    got = {r["row"]["doc_id"]: r for r in rows}
    for (i, _, host, path), e in zip(docs, evidence, strict=True):
        p = min(max(rate[host, path], 1e-6), 1 - 1e-6)
        score = 1 / (1 + math.exp(-(e + math.log(p / (1 - p)))))
        assert got[i]["evidence"] == pytest.approx(e, abs=1e-9)
        assert got[i]["site_rate"] == pytest.approx(rate[host, path], abs=1e-9)
        assert got[i]["score"] == pytest.approx(score, abs=1e-9)
        assert got[i]["keep"] == (score >= quality.THRESHOLD)


def test_words_tell_documents_of_one_shape_apart(found):
    docs, labels, _, rows = found
    kind, fitted = dict(labels), {i for i, _ in labels[::2]}
    held_out = [r["keep"] == bool(kind[r["row"]["doc_id"]]) for r in rows if r["row"]["doc_id"] in kind and r["row"]["doc_id"] not in fitted]
    assert sum(held_out) / len(held_out) > 0.95
