"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, html_extraction, line_dedup, merkle, near_dedup, packing, prefix_trie, quality, substring_dedup, topk, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_copies(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2("kept", 256).alias("kept_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.filter_urls(_table(spark, sf_dir, "pages", "page_id", "url"))
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extract(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 100 == 0)


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text")).drop("k")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.encode(_table(spark, sf_dir, "documents", "doc_id", "text"), path, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    found = quality.classify(docs, _table(spark, sf_dir, "labels", "doc_id", "quality"))
    return found.select("row.doc_id", "row.source", "row.lang", "evidence", "site_rate", "score", "keep")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic").filter(~held_out))
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("offences").alias("n_offences"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(merkle.document_leaves(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    proof = F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256")
    return found.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", proof, F.col("folded").alias("folded_root"), "verified"
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = prefix_trie.trie(prefix_trie.rebuilt(own))
    return found.withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_line_dedup,
        op3_url_filter,
        op4_substring_dedup,
        op5_html_extraction,
        op6_exact_topk,
        op7_nearest,
        op8_near_dedup,
        op9_bpe,
        op10_quality,
        op11_toxicity,
        op12_merkle,
        op13_prefix_trie,
    )
}
