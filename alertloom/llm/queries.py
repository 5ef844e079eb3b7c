"""The corpus operators as named queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from alertloom.llm import (
    alignment,
    chat,
    decontaminate,
    licenses,
    link_trust,
    merkle,
    ngram_join,
    oracle,
    packing,
    pii,
    quality,
    sharding,
    token_files,
    warc,
)
from alertloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

# Texts are long: a batch sent to Python has few rows and bytes.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return configure(spark)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf, "documents")).drop("is_kept")


def op2_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf, "conversations"))


def op3_warc_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf, "pages"))


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf, "documents"), windows=True)


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("score")


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_stratified_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


def op9_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.private_data(table(spark, sf, "documents"))


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_table(table(spark, sf, "documents"))


def op11_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return link_trust.filter_urls(table(spark, sf, "pages"))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.proof_report(table(spark, sf, "documents"))


def op13_cross_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf, "documents"))


OPERATORS = (
    op1_ngram_jaccard_join,
    op2_chat_formatting,
    op3_warc_assembly,
    op4_license_scan,
    op5_quality_rules,
    op6_decontamination,
    op7_stratified_sharding,
    op8_best_fit_packing,
    op9_personal_data,
    op10_token_files,
    op11_url_filters,
    op12_merkle_manifest,
    op13_cross_tokenizer,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
