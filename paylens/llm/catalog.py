"""The operators' registered queries, over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm import (
    chat_format, circulant_minhash, class_scan_bpe, column_suffixes, compression_toxicity,
    curve_packing, fill_middle, language_id, lexical_search, multi_index, pii_spans, target_quality, url_trust)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@query
def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.find(table(spark, sf_dir, "documents"))


@query
def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return compression_toxicity.score(docs, model)


@query
def op10_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


@query
def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.digests(curve_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


@query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.verdicts(table(spark, sf_dir, "pages"))


ORACLES["op1_url_trust"] = url_trust.oracle()

#: What user and assistant of the added conversation -7 say.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    turns = chat_format.canonical_turns(chat_format.turn_records(rows)).filter("layout is not null")
    found = chat_format.digests(chat_format.format_turns(turns))
    return found.withColumn("conv_id", F.col("conv_id").cast("bigint"))


ORACLES["op2_chat_format"] = chat_format.oracle(CONTROL_TEXT)


@query
def op4_target_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return target_quality.judge(docs, target_quality.log_ratios(docs, trusted))


@query
def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"), similarity=0.98)


ORACLES["op6_multi_index"] = multi_index.oracle(0.98)


@query
def op8_class_scan_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return class_scan_bpe.digests(class_scan_bpe.encode(table(spark, sf_dir, "documents"), path), path)


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


ORACLES["op13_fill_middle"] = fill_middle.oracle()


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_lexical_search"] = lexical_search.oracle()


@query
def op12_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_suffixes.digests(column_suffixes.remove_repeats(table(spark, sf_dir, "documents")))
