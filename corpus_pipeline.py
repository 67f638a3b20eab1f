"""A training-corpus pipeline over ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourpanel.llm import decontam, exact, langid, mixing, near  # noqa: E402
from hourpanel.llm.text import batches_of  # noqa: E402
from hourpanel.session import materialise  # noqa: E402


NEAR_PERCENT = 80  # similarity of five-word shingles from which documents are near copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language the compression classifier rejects."""
    return langid.recognised(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of equal texts."""
    return exact.survivors(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every near-duplicate component."""
    return near.survivors(docs, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per remaining document, how many words the mix takes of it."""
    return mixing.mix(docs).drop("row_no")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: Compression and MinHash cannot be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with batches_of(spark, near.BATCH_BYTES):  # texts in Python and in Arrow buffers beside the heap
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
