"""The trie against plain dictionaries, with odd rows and small shards."""

from __future__ import annotations

import random
import zlib
from hashlib import md5, sha256

import pytest

from stayscope.llm import prefix_trie
from stayscope.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def said(row):
    return (row[2] or "", row[3] or "")


def order(row):
    role, text = said(row)
    return (row[1] is not None, row[1] or 0, md5(f"{len(role.encode())}:{role}{text}".encode()).digest())


def brute_force(rows):
    own: dict = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(row[0], []).append(said(row))
    members: dict = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append((c, len(rebuilt) == d))
    out = []
    for node, of in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(c for c, here in of if here))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((min(c for c, _ in of), len(node), parent, len(of), len(children), len(leaves), saved, sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def found(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted(repr(tuple(r)) for r in op13_prefix_trie(spark, str(tmp_path)).select(*COLUMNS).collect())


def made(n, seed):
    """Conversations with hot first turns, copies, and some that start with others."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        size = rnd.randint(1, 7)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rnd.choice("ab") if t < 4 else f"ü{rnd.randint(0, 3)}") for t in range(size)]
    return rows


ODD = [
    (0, None, None, None),
    (0, 0, "user", "x"),
    (0, 0, "user", "x"),
    (0, 0, "user", "w"),
    (1, 1, "", ""),
    (3, 5, "user", "y" * 100_000),
    (None, 0, "user", "nobody's"),
    (-3, 0, "user", "x"),
    (12, 0, "user", "no first of its family"),
    (12, 1, "user", "é"),
]


@pytest.mark.parametrize("most", [1, 3, prefix_trie.MOST])
@pytest.mark.parametrize("rows", [ODD, made(60, 1), [], [(None, 0, "user", "x")]], ids=["odd", "many", "none", "null"])
def test_equals_brute_force(spark, tmp_path, monkeypatch, rows, most):
    whole = prefix_trie.trie
    monkeypatch.setattr(prefix_trie, "trie", lambda seqs: whole(seqs, most))
    assert found(spark, rows, tmp_path) == brute_force(rows)


def test_ids_of_one_node_in_many_chunks(spark, tmp_path, monkeypatch):
    whole = prefix_trie.distinct_sequences
    monkeypatch.setattr(prefix_trie, "distinct_sequences", lambda seqs: whole(seqs, 2))
    rows = [(5 * c, 0, "user", "the same") for c in range(40)]
    assert found(spark, rows, tmp_path) == brute_force(rows)


def test_double_array_holds_exactly_its_sequences():
    rnd = random.Random(3)
    rows = [[rnd.randint(1, 9) for _ in range(rnd.randint(0, 6))] for _ in range(200)]
    trie = prefix_trie.DoubleArray(rows)
    prefixes = {tuple(r[:d]) for r in rows for d in range(len(r) + 1)}
    nodes = set()
    for p in prefixes:
        node = 1
        for turn in p:
            node = trie.step(node, turn)
            assert node
        nodes.add(node)
        assert [t for t in range(1, 10) if trie.step(node, t)] == [t for t in range(1, 10) if (*p, t) in prefixes]
    assert len(nodes) == len(prefixes)


def test_columns_of_any_name(spark):
    turns = spark.createDataFrame(ODD, SCHEMA)
    more = turns.selectExpr("*", "1 AS `my col`", "2 AS `a.b`", "'x' AS `TEXT`", "3 AS `seq`", "4 AS `select`")
    key = lambda frame: sorted(repr(r) for r in prefix_trie.trie(prefix_trie.sequences(frame)).collect())
    assert key(more) == key(turns)
