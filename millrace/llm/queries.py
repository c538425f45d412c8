"""The operators' queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import ann, decontaminate, line_dedup, lm, mixing, near_dup, pack, pii, quality, token_count
from millrace.llm.common import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.digest(table(spark, sf_dir, "documents"))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.digest(table(spark, sf_dir, "documents"), tokenizer_file())


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.digest(table(spark, sf_dir, "embeddings"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_quality, op3_decontaminate, op4_near_dup, op5_token_count, op6_ann, op7_pack, op8_pii, op9_mix, op10_lm_score)}
