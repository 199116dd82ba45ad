"""The corpus pipeline: quality rules, near-dedup, decontamination, PII, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of its
predecessor; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontaminate, neardup, packing, pii, quality
from mercato.llm.frames import documents
from mercato.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(spark, docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.keep_one(spark, docs)


def template_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.clean(docs, decontaminate.benchmark_table(spark, sf_dir))


def boosted_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Selected spans are replaced in the text by their kind."""
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("template_decontamination", template_decontamination),
    ("boosted_pii", boosted_pii),
    ("best_fit_packing", best_fit_packing),
]

#: tokenisation and the trained models have no SQL form; tests hold the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), spark, f"stage_{name}")
    return docs
