"""The training-data pipeline: from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of `documents`. `run` writes every stage's result as Parquet
and reads it again for the next; so must whoever calls the stages one by one, as a stage
removes the intermediate tables of the one before it. Stages are as robust as their operators: null, empty and
very long texts, repeated rows, empty tables and further columns are all let through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import chunks, lines, minhash, packing, quality_rules
from orderloom.llm.catalog import TOKENIZER
from orderloom.llm.common import corpus_session, materialize, read_table
from orderloom.operators.scratch import recorded_scratch, remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near-duplicate groups and pieces of texts cannot be told in SQL.
ORACLE_SQL = None


def _as_documents(cleaned: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with the number of characters as the text has now."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned.select(*[F.col(f"`{c}`") for c in docs.columns])


# What the last stage stored for its result to read.
_HELD: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, after removing what the one before it had stored: its result is written by now."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _HELD)
        _HELD.clear()
        with recorded_scratch() as stored:
            result = stage(corpus_session(spark), docs, sf_dir)
        _HELD.extend(stored)
        return result

    return run_stage


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule keeps."""
    return quality_rules.select_clean(docs)


@_tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats or nearly repeats."""
    return _as_documents(lines.dedup_lines(docs, report=None), docs)


@_tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return minhash.keep_first(docs)


@_tidy
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have."""
    return _as_documents(chunks.dedup_substrings(docs, report=None), docs)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of at most 1024 ids."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole table `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
