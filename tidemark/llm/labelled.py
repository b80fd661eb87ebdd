"""Bounded training samples from the label table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, kept

# Labelled rows a classifier is fitted on at most, by a hash of doc_id. Statistics of the corpus are
# not bound by this.
TRAIN_ROWS = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a missing id."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds, F.lit(0))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int = TRAIN_ROWS
) -> DataFrame:
    """doc_id, text, label (0.0 or 1.0) of at most ``rows`` labelled documents outside the held-out fold.

    Ids with several labels count as the largest; of an id with several texts the one of least hash counts.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("double").alias("label"))
        .where(F.col("label_id").isNotNull() & F.col("label").isNotNull())
        .where(fold(F.col("label_id"), folds) != held_out)
        .groupBy("label_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(rows)
    )
    chosen = kept(chosen, "chosen")
    texts = documents(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).drop("label_id")
    if texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return texts
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    return texts.groupBy("doc_id", "label").agg(first).select("doc_id", F.col("first.text").alias("text"), "label")
