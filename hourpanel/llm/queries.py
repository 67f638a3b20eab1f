"""Registered queries over the whole ``documents`` table, one per operator, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourpanel.llm import alignment, conversations, ctw, decontam, exact, langid, licenses, mixing, near, pii, token_scan, token_table, toxicity
from hourpanel.llm.text import read_documents


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read_documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.count_tokens(read_documents(spark, sf_dir)).select("doc_id", "n_tokens")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.contained_items(read_documents(spark, sf_dir), items).drop("text_key")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_documents(spark, sf_dir))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(read_documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(read_documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(read_documents(spark, sf_dir), labels)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read_documents(spark, sf_dir))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_documents(spark, sf_dir))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table.token_files(read_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_token_counts, op3_mix_sources, op4_personal_data, op5_decontaminate,
    op6_license_scan, op7_lm_scores, op8_language_id, op9_toxicity, op10_exact_dedup,
    op11_align_tokenizers, op12_repair_conversations, op13_token_table,
)}

ORACLE = {"op10_exact_dedup": exact.EXACT_SQL}
