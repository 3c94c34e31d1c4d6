"""From documents to training sequences: five stages, each on all that the one before it kept.

Toxic documents go; of similar lines one stays; of similar documents one stays; documents that repeat
the benchmark go; the rest is packed. Every stage is written as Parquet and read again, so that a
lost executor costs the stage it works on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm.fuzzy_lines import dedup_lines
from seriesmill.llm.packing import pack
from seriesmill.llm.prefix_join import keep_one_per_component
from seriesmill.llm.string_kernel import drop_toxic, fit_on_labels
from seriesmill.llm.suffix_arrays import decontaminate
from seriesmill.sources.tables import materialise


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the machine learns from ``docs`` and the labels of ``sf_dir``.

    A null text scores like an empty one; repeated rows score alike; other columns pass through.
    """
    return drop_toxic(docs, fit_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, ``n_chars`` counted anew where lines went.

    A document that loses lines and keeps no visible character is left out: every line of it stands
    in another document. A null text has no lines and stays; repeated rows come out alike.
    """
    cleaned = dedup_lines(docs)
    left = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, counted).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: five-word shingles, similarity 0.8 or more.

    Documents without words are like nothing and stay; of repeated rows of a doc_id one stays.
    """
    return keep_one_per_component(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lies in benchmark windows; those without words stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens; every row is a document, one without text its end token."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: Token ids, a trained machine and components have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
