"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs.  All but the last keep the
columns of `documents`.  A document is a row: repeated rows and null ids pass
through each stage by its operator's own rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duotier.llm import mixing, packing, pii, quality, simhash
from duotier.llm.common import documents, saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the target model; the rest go."""
    return quality.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one that names it."""
    return simhash.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced."""
    return pii.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in files and rows that follow the mixed order."""
    return mixing.in_mixed_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of 2048 ids, which follow the mixed order."""
    return packing.pack(mixing.in_mixed_order(docs), ordered=True)  # as files are read in no set order


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has neither the tokenizer nor the fitted models; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
