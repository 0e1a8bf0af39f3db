"""Registered queries of the operators, each over the whole of its tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stateloom.llm import (
    backoff,
    content_sort,
    license_scan,
    mixing,
    periodic_runs,
    quality,
    reputation,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from stateloom.llm.decontamination import contamination
from stateloom.llm.jaccard import jaccard_components
from stateloom.llm.labelled import table


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; ``TOKENIZERS`` names another folder, the same on all machines."""
    if folder := os.environ.get("TOKENIZERS"):
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.contract(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.contract(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.contract(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), keep=True)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.contract(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.contract(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.contract(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_lm_scoring, op3_decontamination, op4_quality, op5_token_counts,
        op6_token_files, op7_exact_dedup, op8_mixing, op9_toxicity, op10_jaccard_join,
        op11_periodic_runs, op12_whitening, op13_url_filter,
    )
}

#: DuckDB statements of the same results, where SQL can express them.
LLM_ORACLE: dict[str, str] = {"op7_exact_dedup": content_sort.ORACLE, "op13_url_filter": reputation.ORACLE}
