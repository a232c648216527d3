"""The documents that each stage of the pipeline keeps, against plain versions chained in the same way."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_text_dedup import corpus, words
from tokenizers import Tokenizer

import corpus_pipeline
from stayscope.llm import packing, substring_dedup

SCHEMA = "doc_id long, text string, source string, lang string"


def order(row):
    return row[0] is not None, row[0] or 0, row[2]  # null ids first, k last


def without_lines(rows):
    own = {row: [x for x in row[1].split("\n") if x.strip(" \t\r\x0b\x0c")] for row in rows if row[1] is not None}
    first, out = {}, []
    for row in sorted(own, key=order):
        for s in range(len(own[row]) - 1):
            first.setdefault(tuple(own[row][s : s + 2]), (row, s))
    for row in rows:
        lines = own.get(row, [])
        gone = {j for s in range(len(lines) - 1) if first[tuple(lines[s : s + 2])] != (row, s) for j in (s, s + 1)}
        if not gone:
            out.append(row[:2])
        elif len(gone) < len(lines):
            out.append((row[0], "\n".join(x for j, x in enumerate(lines) if j not in gone)))
    return out


def one_of_near_copies(rows):
    sets = []
    for _, text, _ in rows:
        own = words(text, lower=True)
        sets.append({tuple(own[s : s + 5]) for s in range(max(1, len(own) - 4))} if own else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            linked = sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
            if linked or rows[a] == rows[b]:
                label = [label[b] if v == label[a] else v for v in label]
    groups: dict = {}
    for row, v in zip(rows, label, strict=True):
        groups.setdefault(v, []).append(row)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:2] for g in groups.values()]


def without_passages(rows):
    size, seen, out = substring_dedup.WINDOW, Counter(), []
    for _, text, _ in rows:
        own = words(text)
        seen.update(tuple(own[s : s + size]) for s in range(len(own) - size + 1))
    for i, text, _ in rows:
        own = words(text)
        gone = {j for s in range(len(own) - size + 1) if seen[tuple(own[s : s + size])] > 1 for j in range(s, s + size)}
        kept = b" ".join(w for j, w in enumerate(own) if j not in gone).decode()
        if not gone or kept:
            out.append((i, kept if gone else text or ""))
    return out


PLAIN = [lambda rows: [r[:2] for r in rows], without_lines, one_of_near_copies, without_passages]


@pytest.mark.parametrize("seed", [3])
def test_kept_documents(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = corpus(seed, 25)
    nulls = [(None, f"{rows[i][1]} of its own {i}") for i in (0, 3, 5)] + [(None, " ".join(rng.choices("abcdefghijkl", k=60)))]
    rows += [*nulls, *nulls, *rng.choices(rows, k=12), (None, None), (None, None)]
    docs = spark.createDataFrame([(*r, "s", "en") for r in rows], SCHEMA).repartition(4)
    spark.createDataFrame([(-1, 0), (-2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    sizes = [len(rows)]
    for (_, stage), plain in zip(corpus_pipeline.STAGES, PLAIN, strict=False):
        before = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("doc_id", "text")).collect()]
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), corpus_pipeline.work_dir(spark, "test"))
        found = Counter((r["doc_id"], r["text"]) for r in docs.collect())
        assert found == Counter(plain(before))
        sizes.append(sum(found.values()))
    assert sizes[0] == sizes[1] > sizes[2] > sizes[3] > sizes[4] > 20
    code = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter({(i, (*code.encode(t, add_special_tokens=False).ids, packing.END_ID)): n for (i, t), n in found.items()})
    packed = corpus_pipeline.packed(spark, docs, str(tmp_path))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in packed.collect()) == wanted
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(len(ids) * n for (_, ids), n in wanted.items())
    assert all(len(r["ids"]) <= packing.CAPACITY for r in whole)
