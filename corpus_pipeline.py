"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage is one operator of stayscope.llm over all that its predecessor kept. Between
stages the documents are written as Parquet below ``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayscope.llm import line_dedup, near_dedup, packing, quality, substring_dedup
from stayscope.session import materialize, settings, work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents that a Python worker gets at a time: two workers share an executor with its heap.
BATCH_ROWS = 1000
SMALL_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage: Stage) -> Stage:
    """From this stage on the session hands documents to Python in small batches, also when its result is written later."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(SMALL_BATCHES, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.classify(docs, labels).filter("keep").select("row.*")


@in_small_batches
def without_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(docs)


@in_small_batches
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs, one_each=True)


@in_small_batches
def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(docs)


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", without_copied_lines),
    ("MinHash near-dedup", without_near_copies),
    ("substring dedup", without_repeated_passages),
    ("packing", packed),
]

#: The first stage fits a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with settings(spark, {SMALL_BATCHES: str(BATCH_ROWS)}):
        for i, (_, stage) in enumerate(STAGES):
            docs = materialize(stage(spark, docs, sf_dir), work_dir(spark, f"stage-{i + 1}"))
    return docs
