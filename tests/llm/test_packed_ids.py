"""The pipeline's last stage gives the token ids themselves."""

from __future__ import annotations

import corpus_pipeline
from stayscope.llm import packing


def test_the_last_stage_holds_the_sequences(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    rows = packed.collect()
    assert all(len(r["ids"]) == r["length"] for r in rows)
    found = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert all(found[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"] for r in rows)
