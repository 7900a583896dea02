"""The queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (chat, collocations, credentials, decontaminate, exactdedup, language, lexical,
                           packing, passages, quality, setjoin, tokenbin, urlfilter)
from orderloom.llm.common import documents


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf)).drop("removed", "cleaned")


def op2_token_planes(spark: SparkSession, sf: str) -> DataFrame:
    return tokenbin.token_shards(documents(spark, sf), tokenizer("word_bpe_49k.json"))


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passages.dedup_passages(documents(spark, sf)).select(
        "doc_id", "n_lines", "n_removed_lines", "n_cut_lines", "n_removed_words", "removed", "cut",
        F.sha2("text", 256).alias("text_sha256"))


def op4_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return setjoin.jaccard_components(documents(spark, sf), k=3, percent=90)


def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    given = spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat.HOSTILE).alias("text"))
    return chat.chat_digest(given.unionByName(hostile))


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.benchmark_hits(
        documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")).drop("items", "spans")


def op7_credentials(spark: SparkSession, sf: str) -> DataFrame:
    return credentials.secret_scan(documents(spark, sf)).drop("links")


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urlfilter.url_filter(
        spark.read.parquet(f"{sf}/pages.parquet"), urlfilter.RULES).drop("glob")


def op9_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(documents(spark, sf))


def op10_pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed_digest(documents(spark, sf), tokenizer("byte_bpe_50k.json"))


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf))


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.ranked(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op13_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exactdedup.dedup_exact(documents(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_token_planes, op3_line_dedup, op4_jaccard_join, op5_chat_format,
        op6_decontaminate, op7_credentials, op8_url_filter, op9_language, op10_pack,
        op11_collocations, op12_lexical_search, op13_exact_dedup)}
