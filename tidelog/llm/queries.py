"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import (
    align,
    decontaminate,
    hilbert,
    languages,
    manifest,
    mixture,
    near_dedup,
    oracles,
    ppm,
    private_data,
    quality,
    rules,
    token_counts,
    toxicity,
)
from tidelog.llm.texts import reach_workers


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    ).drop("spans")


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.held_out_scores(read(spark, sf_dir, "documents"))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.layout(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(read(spark, sf_dir, "documents"))


def op7_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.shares(read(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(read(spark, sf_dir, "documents"))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.private_spans(read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.link_figures(read(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(read(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_ppm_scores": op2_ppm_scores,
    "op3_hilbert_shards": op3_hilbert_shards,
    "op4_toxicity": op4_toxicity,
    "op5_near_dedup": op5_near_dedup,
    "op6_rule_ledger": op6_rule_ledger,
    "op7_source_mixture": op7_source_mixture,
    "op8_language": op8_language,
    "op9_private_data": op9_private_data,
    "op10_quality_rules": op10_quality_rules,
    "op11_alignment": op11_alignment,
    "op12_token_counts": op12_token_counts,
    "op13_manifest": op13_manifest,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": oracles.decontamination(),
    "op5_near_dedup": oracles.near_duplicates(),
    "op6_rule_ledger": oracles.rule_ledger(rules.CURRENT),
    "op13_manifest": oracles.manifest(),
}
