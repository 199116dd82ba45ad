"""The corpus operators' registered queries: ``opN_<name>`` with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import (
    audit,
    decontaminate,
    html_text,
    neardup,
    oracles,
    packing,
    pii,
    quality,
    ranked,
    secret_scan,
    sharding,
    spots,
    substrings,
    toxicity,
)
from mercato.llm.frames import documents

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle:
            ORACLE_SQL[name] = oracle
        return fn

    return add


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, documents(spark, sf_dir))


@query("op7_quality_rules", oracles.QUALITY)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(spark, documents(spark, sf_dir))


@query("op10_pii_boosted")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


@query("op5_template_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(documents(spark, sf_dir), decontaminate.benchmark_table(spark, sf_dir))


@query("op8_minhash_near_dedup", oracles.NEAR_DUPLICATES)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, documents(spark, sf_dir))


@query("op1_automaton_substring_dedup", oracles.SUBSTRINGS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(spark, documents(spark, sf_dir))


@query("op3_virtual_slot_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(spark, documents(spark, sf_dir))


@query("op4_clause_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(spark, documents(spark, sf_dir), labels)


@query("op9_trigram_secret_scan", oracles.SECRETS)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(spark, documents(spark, sf_dir))


@query("op2_html_main_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op11_blocked_ranked_search", oracles.RANKED)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op12_spot_fingerprints", oracles.SPOTS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.edited_fingerprints(documents(spark, sf_dir))


@query("op13_filter_audit", oracles.AUDIT)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit.audit(audit.masks(documents(spark, sf_dir), labels))
