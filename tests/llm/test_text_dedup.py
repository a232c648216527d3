"""Line, passage and near-copy removal against plain brute force, and their edge cases."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from stayscope.llm import line_dedup, near_dedup, substring_dedup
from stayscope.llm.graph import components

SPACES = b" \t\n\r\x0b\x0c"


def words(text, lower=False):
    raw = (text or "").encode()
    if lower:
        raw = bytes(b + 32 if 65 <= b < 91 else b for b in raw)
    for b in SPACES:
        raw = raw.replace(bytes([b]), b" ")
    return [w for w in raw.split(b" ") if w]


def corpus(seed, n=60):
    """Texts with copies, near copies, shared passages, repeated words and odd cases."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é x", "Ünï", "a\x1cb", "W1"]
    texts = []
    passage = " ".join(rng.choices(vocabulary, k=50))
    for _ in range(n):
        own = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 40, 120]))
        lines = [" ".join(own[i : i + 9]) for i in range(0, len(own), 9)]
        text = "\n".join(lines)
        if rng.random() < 0.3:
            text = text + "\n" + passage + "\n" + text[:20]
        texts.append(text)
        if rng.random() < 0.4:
            edited = text.split(" ")
            edited[rng.randrange(len(edited))] = "changed"
            texts.append(" ".join(edited))
        if rng.random() < 0.2:
            texts += [text, text.upper()]
    texts += [None, "", "   \n\t", "same " * 300, "one two " * 90, "one two " * 60, "short", "short"]
    return list(enumerate(texts))


@pytest.fixture(scope="module", params=[1, 2])
def docs(spark, request):
    rows = corpus(request.param)
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_substrings(docs):
    rows, frame = docs
    size, seen = substring_dedup.WINDOW, Counter()
    for _, text in rows:
        own = words(text)
        seen.update(tuple(own[s : s + size]) for s in range(len(own) - size + 1))
    found = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.remove_repeats(frame).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for s in range(len(own) - size + 1):
            if seen[tuple(own[s : s + size])] > 1:
                gone[s : s + size] = [True] * size
        kept = b" ".join(w for w, g in zip(own, gone, strict=True) if not g).decode()
        assert found[i] == (len(own), sum(gone), kept)


def test_substrings_with_frequent_anchors(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 2)
    test_substrings(docs)


def test_near_copies(docs):
    rows, frame = docs
    sets = {}
    for i, text in rows:
        own = words(text, lower=True)
        sets[i] = {tuple(own[s : s + 5]) for s in range(max(1, len(own) - 4))} if own else set()
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(frame).collect()}
    assert found == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def test_near_copies_left_to_blocks(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    test_near_copies(docs)


def test_every_coordinate_is_filled_and_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 40, 3000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        assert (near_dedup.sketch(a) != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    common, one, two = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (800, 100, 100))
    same = near_dedup.sketch(np.concatenate((common, one))) == near_dedup.sketch(np.concatenate((common, two)))
    assert abs(same.mean() - 0.8) < 0.12


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_lines(docs, min_lines):
    rows, frame = docs
    sequences = {i: [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")] for i, text in rows if text is not None}
    first = {}
    for i in sorted(sequences):
        own = sequences[i]
        for s in range(len(own) - min_lines + 1):
            first.setdefault(tuple(own[s : s + min_lines]), (i, s))
    found = {r["row"]["doc_id"]: r for r in line_dedup.remove_copies(frame, min_lines).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        own = sequences.get(i, [])
        gone = set()
        for s in range(len(own) - min_lines + 1):
            if first[tuple(own[s : s + min_lines])] != (i, s):
                gone |= set(range(s, s + min_lines))
        runs = [j for j in gone if j - 1 not in gone]
        longest = max((next(e for e in range(j, len(own) + 1) if e not in gone) - j for j in runs), default=0)
        kept = "\n".join(x for j, x in enumerate(own) if j not in gone)
        assert (found[i]["n_lines"], found[i]["n_removed"], found[i]["n_runs"], found[i]["longest_run"], found[i]["kept"]) == (
            len(own),
            len(gone),
            len(runs),
            longest,
            kept,
        )


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    label = {x: x for e in edges for x in e}
    for a, b in edges:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {k: new if v == old else v for k, v in label.items()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: v for k, v in label.items() if k in linked}


OPERATORS = {
    "lines": (line_dedup.remove_copies, line_dedup.line_dedup),
    "substrings": (substring_dedup.remove_repeats, substring_dedup.substring_dedup),
    "near": (near_dedup.near_duplicates, near_dedup.near_dedup),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    frame = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    for operator in OPERATORS[name]:
        assert operator(frame).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_repeated_rows_and_clashing_names(spark, name):
    long = " ".join(f"v{i}" for i in range(60))
    both = f"{long}\nsecond line of it\nthird line of it"
    rows = [(None, both), (None, None), (4, both), (4, both), (5, None), (6, ""), (7, "alone")]
    names = "k string, z int, row string, anchor int, rank int, i int, kept string, node string, lines int, band int, label string, n int"
    frame = spark.createDataFrame([(i, t, "x", *([None] * 11)) for i, t in rows], f"doc_id long, text string, {names}")
    about, kept = OPERATORS[name]
    assert about(frame).count() == len(rows)
    left = kept(frame)
    assert left.columns == frame.columns
    texts = Counter(r["text"] or "" for r in left.collect())
    assert texts["alone"] == 1
    if name == "near":
        assert texts[both] == 2  # null ids are never the least; rows that repeat id and text stay together
    if name == "lines":
        assert texts[both] == 1  # the null id comes first, and the others are later copies
    if name == "substrings":
        assert texts["second line of it third line of it"] == 0


def test_long_documents(spark):
    rng = random.Random(9)
    big = "\n".join(" ".join(f"x{rng.randrange(10**6)}" for _ in range(20)) for _ in range(4000))
    frame = spark.createDataFrame([(1, big), (2, "head\n" + big), (3, "one line")], "doc_id long, text string")
    assert {r["row"]["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(frame).collect()} == {1: 80_000, 2: 80_000, 3: 0}
    assert {r["row"]["doc_id"]: r["n_removed"] for r in line_dedup.remove_copies(frame).collect()} == {1: 0, 2: 4000, 3: 0}
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()} == {1: 1, 2: 1, 3: 3}


def test_native_plan_of_lines(spark):
    frame = spark.createDataFrame(corpus(1, 5), "doc_id long, text string")
    plan = line_dedup.remove_copies(frame)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("MapInArrow", "MapInPandas", "PythonUDF", "ArrowEval"))


def test_texts_that_lose_nothing_stay_as_they_are(spark):
    frame = spark.createDataFrame([(1, " odd \t spacing\n\nkept "), (2, "b")], "doc_id long, text string")
    for _, kept in OPERATORS.values():
        assert {r["doc_id"]: r["text"] for r in kept(frame).collect()} == {1: " odd \t spacing\n\nkept ", 2: "b"}


def test_hashes_of_words_follow_their_bytes():
    from stayscope.llm.words import Words

    texts = [b"a bb a", b"", b"  bb\x85 a\x0b", "é é".encode()]
    found = Words(texts)
    by_word = defaultdict(set)
    flat = [w for t in texts for w in t.split()]
    for w, v in zip(flat, found.value.tolist(), strict=True):
        by_word[w].add(v)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({next(iter(v)) for v in by_word.values()}) == len(by_word)
