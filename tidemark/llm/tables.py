"""Reading inputs and keeping intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import run_dir

# A side is broadcast only when it was counted and has at most this many rows of a few dozen bytes.
BROADCAST_ROWS = 1 << 18
# The same for rows of a single number.
BROADCAST_NUMBERS = 1 << 20
# The same in bytes, for rows that hold lists.
BROADCAST_BYTES = 64 << 20
# Bytes of a batch between the JVM and Python; both sides hold one or two per task.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most ``BATCH_BYTES`` go to Python meanwhile, whatever texts a row holds."""
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shrink(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted rows are few, else for a hash join by shuffle."""
    return F.broadcast(df) if rows <= limit else df.hint("shuffle_hash")


def shrink_lists(df: DataFrame, column: str) -> DataFrame:
    """As :func:`shrink` for rows with a list of flat structs: its items are counted, not the rows alone."""
    item = 16 + 8 * len(df.schema[column].dataType.elementType.fields)
    size = df.agg(F.sum(F.size(column) * item + 64)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("shuffle_hash")


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and the columns asked for) alone, so that no further column can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` rows whose columns of the same names are in ``keys`` (null equals null)."""
    names = keys.columns
    keys = kept(keys.distinct(), "keys")
    renamed = keys.select(*[F.col(c).alias(f"__tm_key_{c}") for c in names])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__tm_key_{c}")) for c in names])
    return docs.join(shrink(renamed, keys.count()), same, how)


def only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return _matching(docs, keys, "left_semi")


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return _matching(docs, keys, "left_anti")
