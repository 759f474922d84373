"""Registered queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chainframe.llm import bpe, chat, decontamination, exactdedup, fertility, licenses, linededup, packing, periodic, resampling, secretscan, simhash, toxicity
from chainframe.llm.common import documents


def op1_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, ranks = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return fertility.quality(documents(spark, sf_dir), pieces, ranks)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_spans(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_lines(documents(spark, sf_dir))


def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.dedup(documents(spark, sf_dir), exactdedup.new_index(spark), "documents")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(documents(spark, sf_dir))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_sample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_chat_parts, op2_fertility, op3_line_dedup, op4_packing, op5_secrets, op6_toxicity, op7_byte_bpe, op8_licenses, op8_license_notices, op9_simhash, op10_exact_dedup, op11_periodic, op12_decontamination, op13_resampling)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_parts": chat.ORACLE_SQL,
        "op3_line_dedup": linededup.ORACLE_SQL,
        "op8_licenses": licenses.ORACLE_SQL,
        "op10_exact_dedup": exactdedup.ORACLE_SQL,
        "op12_decontamination": decontamination.ORACLE_SQL,
        "op13_resampling": resampling.ORACLE_SQL,
    }
