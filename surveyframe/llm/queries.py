"""Registered queries of this subpackage; each reads whole tables of the given folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, chat, decontam, embeddings, katz, langid, packing, pii, secretscan, setjoin, spelling, substring, warc
from .oracle import ORACLE  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op1_query(_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.op2_query(_table(spark, sf_dir, "documents"))


def op3_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.op3_query(_table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op4_query(_table(spark, sf_dir, "conversations"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op5_query(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op6_query(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op7_query(_table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op8_query(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.op9_query(_table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.op10_query(_table(spark, sf_dir, "embeddings"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.op11_query(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op12_query(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.op13_query(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_ngram_join, op3_katz_scoring, op4_chat_format, op5_best_fit_packing, op6_language_id, op7_warc,
                                   op8_decontamination, op9_substring_dedup, op10_embedding_dedup, op11_secret_scan,
                                   op12_spelling_variants, op13_token_alignment)}
