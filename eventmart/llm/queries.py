"""The operators as registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import audit, decontaminate, licenses, lines, mtree, neardup, packing, pii, quality, shards, toxicity, trie, urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(plan: Query) -> Query:
    QUERIES[plan.__name__] = plan
    return plan


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(_read(spark, folder, "documents"))[0]


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_classes(_read(spark, folder, "documents"))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(_read(spark, folder, "pages"))


@query
def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, folder, "documents"))


@query
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@query
def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(_read(spark, folder, "embeddings"))


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_read(spark, folder, "documents"), TOKENIZER).drop("ids")


@query
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(_read(spark, folder, "documents"))


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.filter_audit(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@query
def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_read(spark, folder, "documents"))


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(_read(spark, folder, "conversations"))
