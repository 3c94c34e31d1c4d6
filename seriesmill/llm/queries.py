"""One query per operator over its whole table, and the corpus pipeline. ``ORACLE`` has the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm.bootstrap_pii import find_personal_data
from seriesmill.llm.brown_lm import score_texts
from seriesmill.llm.filter_audit import text_filter_audit
from seriesmill.llm.fuzzy_lines import dedup_lines
from seriesmill.llm.line_frequency import line_frequency_verdicts
from seriesmill.llm.oracle import ORACLE
from seriesmill.llm.packing import pack
from seriesmill.llm.pivot_index import near_duplicates
from seriesmill.llm.prefix_join import jaccard_components
from seriesmill.llm.source_divergence import source_divergence
from seriesmill.llm.string_kernel import toxicity
from seriesmill.llm.suffix_arrays import contamination
from seriesmill.llm.token_counts import token_counts
from seriesmill.llm.url_models import judge_urls


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency_verdicts(_documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir), n=3, percent=90)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_documents(spark, sf_dir))


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_filter_audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_documents(spark, sf_dir))


def op13_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_models": op1_url_models,
    "op2_line_frequency": op2_line_frequency,
    "op3_decontamination": op3_decontamination,
    "op4_personal_data": op4_personal_data,
    "op5_token_counts": op5_token_counts,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_fuzzy_line_dedup": op8_fuzzy_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_brown_lm": op10_brown_lm,
    "op11_filter_interaction": op11_filter_interaction,
    "op12_source_divergence": op12_source_divergence,
    "op13_near_duplicate_vectors": op13_near_duplicate_vectors,
}

__all__ = ["ORACLE", "QUERIES"]
