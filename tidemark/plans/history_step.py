"""One micro-batch into a history table.

With a ledger the rows of a batch are first written to a folder named after it, which no reader sees and a
retry writes anew. Once they are complete the table takes note of the folder; from then on a retry, or the
next batch, only moves its files into the table. So a lost driver neither loses rows nor adds any twice,
whatever the rows hold.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_BROADCAST_BYTES, JOIN_KEY, MergeRules
from tidemark.functions.keys import history_columns
from tidemark.operators.history import unseen_rows
from tidemark.operators.sizing import Size, broadcast_if, measure
from tidemark.plans.partitions import (
    Delivery,
    add_partitions,
    applied,
    distinct_values,
    in_partitions,
    mark_applied,
    properties,
    set_properties,
    was_applied,
)
from tidemark.session import remove_dir, run_dir
from tidemark.sources.tables import TableRef


@dataclass(frozen=True)
class HistoryReport:
    batch_rows: int
    inserted: int
    skipped: bool = False


ADDING = "tidemark.adding"
_MOVERS = 8  # files renamed at a time


def apply_history_batch(
    spark: SparkSession,
    batch: DataFrame,
    table: TableRef,
    transport: tuple[str, ...] = (),
    key_cols: tuple[str, ...] = (),
    rules: MergeRules = MergeRules(),
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    size: Size | None = None,
    delivery: Delivery | None = None,
) -> HistoryReport:
    """Append the batch rows that the table does not hold yet.

    The table is narrowed before the full comparison: equal rows are in the same
    partition when the partition column is compared; otherwise a scan of key and
    partition column alone finds the partitions that can hold an equal row.

    With ``delivery`` a batch that was applied is skipped, and one that was interrupted is added as if it
    had not been.
    """
    stored = finish_adding(spark, table)
    if was_applied(stored, delivery):
        return HistoryReport(batch_rows=0, inserted=0, skipped=True)
    # Another session may have appended: this one's file list is renewed before comparing.
    spark.catalog.refreshTable(table.sql_name)
    rows = batch.drop(JOIN_KEY, *transport)
    size = size or measure(rows)
    small = size.within(broadcast_bytes)
    compare = history_columns(rows.columns)
    history = spark.table(table.sql_name)

    part = table.partition_col
    if part in compare:
        history = history.where(in_partitions(part, distinct_values(rows, part)))
    elif part and (keys := _compared_keys(key_cols, compare)):
        wanted = rows.select(*[F.col(k).alias(f"_w_{k}") for k in keys]).distinct()
        sign = "<=>" if rules.null_safe else "="
        same = " AND ".join(f"`{k}` {sign} `_w_{k}`" for k in keys)
        # Keys and partitions only: a big batch shuffles these few columns, not the whole table.
        located = history.select(*keys, part) if small else history.select(*keys, part).distinct()
        held = located.join(broadcast_if(wanted, small), F.expr(same), "left_semi")
        history = history.where(in_partitions(part, distinct_values(held, part)))

    work = run_dir(spark, "history-matches")

    def cut(df: DataFrame) -> DataFrame:
        df.write.parquet(work)
        return spark.read.schema(df.schema).parquet(work)

    fresh = unseen_rows(rows, history, compare, rules.null_safe, small, cut).select(*history.columns)
    if part:
        # Few, evenly sized files per partition; AQE splits a partition that is too big.
        fresh = fresh.hint("rebalance", part)
    # Counted while writing, so no count of the table before and after is needed.
    written = Observation()
    fresh = fresh.observe(written, F.count(F.lit(1)).alias("n"))
    if delivery is None:
        fresh.write.insertInto(table.sql_name)
    else:
        add_staged(spark, table, stage_rows(fresh, table, delivery), delivery)
    if not small:
        remove_dir(spark, work)
    return HistoryReport(batch_rows=size.rows, inserted=written.get["n"])


def append_rows(spark: SparkSession, rows: DataFrame, table: TableRef, delivery: Delivery | None = None) -> None:
    """Append to a plain table; with ``delivery`` once, whenever the driver is lost."""
    stored = finish_adding(spark, table)
    if was_applied(stored, delivery):
        return
    if delivery is None:
        rows.write.insertInto(table.sql_name)
    else:
        add_staged(spark, table, stage_rows(rows, table, delivery), delivery)


def stage_rows(rows: DataFrame, table: TableRef, delivery: Delivery) -> str:
    """Write a batch's rows, in the table's types, to its own folder; what an earlier try left there goes."""
    spark = rows.sparkSession
    folder = f"{table.location}/_staged/{delivery.query}-{delivery.batch}"
    schema = spark.table(table.sql_name).schema
    typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    by = [table.partition_col] if table.partition_col else []
    typed.write.mode("overwrite").format(table.format).partitionBy(*by).save(folder)
    return folder


def add_staged(spark: SparkSession, table: TableRef, folder: str, delivery: Delivery) -> None:
    """Take note of a complete folder, then move its files into the table."""
    set_properties(spark, table, **{ADDING: f"{delivery.text}|{folder}"})
    _move_in(spark, table, folder, delivery)


def finish_adding(spark: SparkSession, table: TableRef) -> dict[str, str]:
    """Add what a lost driver had noted but not moved; returns the table's properties."""
    stored = properties(spark, table)
    text, _, folder = stored.get(ADDING, "").partition("|")
    if not folder:
        return stored
    delivery = Delivery.parse(text)
    _move_in(spark, table, folder, delivery)
    return stored | applied(delivery)


def _move_in(spark: SparkSession, table: TableRef, folder: str, delivery: Delivery | None) -> None:
    """Repeatable: partitions first, then every file still in the folder, by a name no other write uses."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    root = files.makeQualified(path(folder)).toString().rstrip("/") + "/"
    found, listed = [], files.listFiles(path(folder), True) if files.exists(path(folder)) else None
    while listed is not None and listed.hasNext():
        place = listed.next().getPath().toString().removeprefix(root)
        if not place.rpartition("/")[2].startswith(("_", ".")):
            found.append(place)
    if table.partition_col:
        add_partitions(spark, table, sorted({place.rpartition("/")[0] for place in found}))

    def move(place: str) -> None:
        target = path(f"{table.location}/{place}")
        files.mkdirs(target.getParent())
        if not files.rename(path(f"{folder}/{place}"), target):
            raise RuntimeError(f"cannot move {folder}/{place}")

    with ThreadPoolExecutor(_MOVERS) as pool:
        list(pool.map(move, found))
    spark.catalog.refreshTable(table.sql_name)
    # In this order: lost in between, the batch is marked once more, and nothing is left to move.
    mark_applied(spark, table, delivery)
    set_properties(spark, table, **{ADDING: ""})
    remove_dir(spark, folder)


def _compared_keys(key_cols: tuple[str, ...], compare: list[str]) -> list[str]:
    """The key columns that are compared, by the names of the rows; case does not matter."""
    wanted = {k.lower() for k in key_cols}
    return [c for c in compare if c.lower() in wanted]
