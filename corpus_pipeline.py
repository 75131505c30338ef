"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Language identification and toxicity drop documents, near-dedup keeps one of
each group, personal data is masked, and what remains is packed into token
sequences.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm import (
    circulant_minhash, compression_toxicity, curve_packing, language_id, pii_spans)
from paylens.llm.catalog import table, tokenizer_path
from paylens.llm.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a clear language go."""
    return language_id.accepted(docs, language_id.fit(docs))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; labels come from the tables' folder."""
    model = compression_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return compression_toxicity.without_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8)."""
    return circulant_minhash.deduplicate(docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts is replaced by its kind."""
    return pii_spans.mask(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a token sequence, with its ids (little-endian, 32 bits)."""
    return curve_packing.pack(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Trained models, near-duplicate components and a tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.settle(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
