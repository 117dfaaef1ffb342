"""A training-data pipeline over ``documents``: each stage applies one operator and its
decisions, and is written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from envflow.llm import decontaminate, language_id, near_dedup, packing, secret_scan
from envflow.llm.common import stored, table

#: A document whose best language scores less is rejected, or knows too little of it (``language_id.LEAST_KNOWN``).
LEAST_LANGUAGE_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no likely language, go."""
    return language_id.reject_unknown(docs, LEAST_LANGUAGE_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return near_dedup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as pieces of packed sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed),
]

#: SQL can express neither the language model nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
