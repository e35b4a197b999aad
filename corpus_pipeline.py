"""Corpus pipeline: quality rules, near-dedup, decontamination, masking, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lifeline.llm import bpe_words, decision_list, decontaminate, minmax_dedup, pii_votes
from lifeline.llm.queries import tokenizer
from lifeline.llm.tables import save

#: The stages learn models and share corpus-wide groups, which SQL can't state.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return decision_list.keep_good(docs, decision_list.train(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minmax_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets."""
    return pii_votes.mask(docs, pii_votes.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the remaining texts, with digests of ids and decoded text."""
    return bpe_words.digests(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("masking", masking),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, f"pipeline-{name}")
    return docs
