"""The corpus operators as registered queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import (
    audit, bpe, chunks, classifier, grid_join, lines, minhash, packing, quality_rules, sharding, topk, tries, warc,
)
from orderloom.llm.common import corpus_session, given_id, materialize, read_table, scratch_path
from orderloom.llm.oracle import SQL

__all__ = ["QUERIES", "SQL", "TOKENIZER"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(corpus_session(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


@register
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = chunks.dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "repeats.*")


@register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "lines.*")


@register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"quality.{c}" for c in (*counts, "base_failed", "kept", "failed_rules")])


@register
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(read_table(spark, sf_dir, "documents"), TOKENIZER)
    both = bpe.decode(ids, TOKENIZER)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@register
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5, 256)


@register
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    scored = classifier.classify(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), F.coalesce(held_out, F.lit(False))
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


@register
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER)


@register
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.classes(read_table(spark, sf_dir, "documents"))
    return found.select(
        given_id(F.col("key")).alias("doc_id"), given_id(F.col("class_id")).alias("class_id"), "class_size", "kept"
    )


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    files = warc.write_archive(read_table(spark, sf_dir, "pages"), folder)
    if files.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    records = materialize(warc.read_archive(spark, folder, files, payloads=False), "warc-records")
    damaged = records.filter("problem is not null").count()
    if damaged:
        raise ValueError(f"{damaged} damaged stretches in the archives of {folder}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_vectors(read_table(spark, sf_dir, "embeddings"))


@register
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(read_table(spark, sf_dir, "conversations"))
