"""The manifest against a plain tree, with odd rows and small blocks."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from stayscope.llm import merkle
from stayscope.llm.queries import op12_merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_force(rows):
    """The whole trees, and for a changed leaf the whole trees again."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(*r)))
    sources = list(dict.fromkeys(r[1] for r in rows))
    trees = {s: levels_of([leaf(*r) for r in rows if r[1] == s]) for s in sources}
    top = levels_of([trees[s][-1][0] for s in sources])
    out, seen = [], dict.fromkeys(sources, 0)
    for r in rows:
        s, at = r[1], seen[r[1]]
        seen[s] += 1
        proof, place = "", at
        for tree, place in ((trees[s], at), (top, sources.index(s))):
            for level in tree[:-1]:
                run = level[place - place % 3 : place - place % 3 + 3]
                proof += "".join(run[: place % 3] + run[place % 3 + 1 :])
                place //= 3
        text = r[4]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        again = [*trees[s][0]]
        again[at] = leaf(*r[:4], text)
        folded = levels_of([levels_of(again)[-1][0] if x == s else trees[x][-1][0] for x in sources])[-1][0]
        root = top[-1][0]
        out.append((r[0], leaf(*r), trees[s][-1][0], root, h(proof), folded, folded == root))
    return sorted(map(repr, out))


def found(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    result = op12_merkle(spark, str(tmp_path))
    return sorted(repr(tuple(r)) for r in result.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


ODD = [
    (1, None, "en", 3, "a\nb"),
    (2, None, None, None, None),
    (None, "s", "en", 1, "x\ny"),
    (None, "s", "en", 1, "x\ny"),
    (5, "s", "de", 0, ""),
    (5, "s", "de", 0, ""),
    (5, "s", "de", 0, "\n\n"),
    (7, "é", "fr", 2, "é\n" * 5000),
    (8, "z", "fr", 2, None),
    (4, "", "fr", 2, "one\nline\n"),
]
MANY = [(i, f"s{i % 3 % 2}", "en", i, f"text {i}\nline" if i % 4 else None) for i in range(40)]


@pytest.mark.parametrize("rows", [ODD, MANY, ODD[:1], MANY[:3], []], ids=["odd", "many", "one", "three", "none"])
@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_equals_brute_force(spark, tmp_path, monkeypatch, rows, levels):
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda leaves: whole(leaves, levels))
    if levels != merkle.LEVELS and len(rows) > 10:
        rows = rows[:23]  # several rounds, with an incomplete last block
    assert found(spark, rows, tmp_path) == brute_force(rows)


def test_versions_share_what_they_do_not_change():
    block = merkle.Block([h(str(i)) for i in range(9)], 2)
    changed = merkle.Block([h("x") if i == 4 else h(str(i)) for i in range(9)], 2)
    assert merkle.version(h("x"), block.siblings(4)) == changed.top
    assert merkle.version(h("4"), block.siblings(4)) == block.top
    differing = [sum(a != b for a, b in zip(x, y, strict=True)) for x, y in zip(block.nodes, changed.nodes, strict=True)]
    assert differing == [1, 1, 1]  # an ancestor on each level, nothing else


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame(MANY[:5], SCHEMA)
    more = docs.selectExpr("*", "1 AS `my col`", "2 AS `a.b`", "'x' AS `TEXT`", "3 AS `row`", "4 AS `select`")
    key = lambda frame: sorted(r["digest"] for r in merkle.manifest(merkle.document_leaves(frame)).collect())
    assert key(more) == key(docs)


@pytest.mark.parametrize(("n", "wanted"), [(1, 0), (2, 1), (3, 1), (4, 2), (9, 2), (10, 3)])
def test_height(n, wanted):
    assert merkle.height(n) == wanted
