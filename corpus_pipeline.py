"""A training-data pipeline: five stages, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of ``documents``; the last returns the mix: doc_id, size,
source_size, target, taken. A row is dropped only by a stage's decision: toxic text, a copy of a text
that stays, a near copy of a document that stays, a document that holds a benchmark item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, exact_dedup, mixing, ngram_join, toxicity
from tidemark.llm.tables import kept, read, without

# Training and scoring, components and seeded draws are not SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the classifier learns from the labels of the documents at hand."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest doc_id stays."""
    groups = ngram_join.join(docs)
    return without(docs, groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
