"""Changes placed by their own time, in whatever order they arrive.

All changes of a feed are kept, as they came, in a table of their own. A key is late in a batch when that
table holds a change of it that does not precede the batch's first one. The versions of such a key are made
anew from all its changes; other keys go on from their active version. Both give what one batch of all
changes in order would give, so the order of arrival has no bearing on the table. A change that is delivered
again, equal in every column, counts once; a batch that is repeated after a failure finds its own changes
kept already, and makes those keys anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import JOIN_KEY, CdcFeed
from tidemark.operators.merge import CLAUSE, INSERTED, ORIGIN, REMOVED, UNTOUCHED
from tidemark.operators.sizing import broadcast_if, measure
from tidemark.sources.tables import TableRef

_AT, _FIRST, _LATE = "_lc_at", "_lc_first", "_lc_key"


def _at(order_cols: Sequence[str]) -> Column:
    """Place of a change within its key; in a struct nulls come first."""
    return F.struct("ds", *order_cols).alias(_AT)


def late_keys(changes: DataFrame, kept: DataFrame, order_cols: Sequence[str], small: bool) -> DataFrame:
    """Keys of ``changes`` of which ``kept`` has a change at or after the first new one.

    Only days from the first new change on are read of ``kept``.
    """
    first = changes.select(JOIN_KEY, _at(order_cols)).groupBy(F.col(JOIN_KEY).alias(_LATE)).agg(F.min(_AT).alias(_FIRST))
    days = changes.agg(F.min("ds").alias("day"), F.count_if(F.col("ds").isNull()).alias("undated")).first()
    if days["day"] is not None and not days["undated"]:
        kept = kept.where(F.col("ds") >= F.lit(days["day"]))
    # The last one per key is enough, so that a key with very many changes travels once per map task.
    last = kept.select(JOIN_KEY, _at(order_cols)).groupBy(JOIN_KEY).agg(F.max(_AT).alias(_AT))
    met = last.join(broadcast_if(first, small), F.col(JOIN_KEY) == F.col(_LATE))
    return met.where(F.col(_AT) >= F.col(_FIRST)).select(_LATE)


def of_keys(rows: DataFrame, late: DataFrame, small: bool, how: str = "left_semi") -> DataFrame:
    return rows.join(broadcast_if(late, small), F.col(JOIN_KEY) == F.col(_LATE), how)


def place_by_time(
    spark: SparkSession, batch: DataFrame, changes_table: TableRef, feed: CdcFeed, work: str
) -> tuple[DataFrame, DataFrame | None, bool]:
    """(changes to fold, late keys or None, whether these are few); the batch is kept from here on.

    The late keys and their changes are written to ``work`` before the batch joins the kept changes, so that
    whatever is computed again later sees the same ones.
    """
    spark.catalog.refreshTable(changes_table.sql_name)
    kept = spark.table(changes_table.sql_name)
    fresh = batch.select(*kept.columns).distinct()
    fresh.write.parquet(f"{work}/fresh")
    fresh = spark.read.schema(kept.schema).parquet(f"{work}/fresh")
    small = measure(fresh.select(JOIN_KEY, "ds", *feed.order_cols)).within(feed.broadcast_bytes)
    late_keys(fresh, kept, feed.order_cols, small).write.parquet(f"{work}/late")
    late = spark.read.schema(f"{_LATE} STRING").parquet(f"{work}/late")
    size = measure(late)
    changes, few = fresh, size.within(feed.broadcast_bytes)
    if size.rows:
        every = of_keys(kept, late, few).unionByName(of_keys(fresh, late, few)).distinct()
        every.write.parquet(f"{work}/every")
        every = spark.read.schema(kept.schema).parquet(f"{work}/every")
        changes = of_keys(fresh, late, few, "left_anti").unionByName(every)
    fresh.hint("rebalance", "ds").write.insertInto(changes_table.sql_name)
    return changes, late if size.rows else None, few


def replace_versions(
    updated: DataFrame, inserts: DataFrame, matched: DataFrame, late: DataFrame, few: bool, part: str
) -> tuple[DataFrame, DataFrame]:
    """``updated`` and ``inserts`` with the versions of late keys made anew; equal ones stay where they are."""
    columns = [c for c in inserts.columns if c != CLAUSE]
    held = of_keys(matched, late, few).select(*columns)
    come = of_keys(inserts, late, few).select(*columns)

    def tagged(rows: DataFrame, clause: int) -> DataFrame:
        return rows.select("*", F.lit(clause).alias(CLAUSE), F.col(part).alias(ORIGIN)).select(*updated.columns)

    stay, gone = held.intersectAll(come), held.exceptAll(come)
    updated = of_keys(updated, late, few, "left_anti").unionByName(tagged(stay, UNTOUCHED)).unionByName(tagged(gone, REMOVED))
    new = come.exceptAll(held).withColumn(CLAUSE, F.lit(INSERTED))
    return updated, of_keys(inserts, late, few, "left_anti").unionByName(new)
