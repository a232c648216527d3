"""The registered queries against their SQL, and the pipeline against its parts."""

from __future__ import annotations

from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from stayscope.llm.equivalents import SQL
from stayscope.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    found = contract.queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_without_sql_has_its_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_stages_of_the_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, counts = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.dtypes == docs.dtypes
        before = corpus_pipeline.materialize(after, corpus_pipeline.work_dir(spark, "test"))
        counts.append(before.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    code = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    code.no_truncation()
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    total = {i: len(code.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    found: dict = {}
    for r in packed:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == total
