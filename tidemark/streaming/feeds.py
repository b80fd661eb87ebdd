"""One streaming query per feed: decode, then history and versioned table per batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.config import CdcFeed, FlatFeed
from tidemark.functions.frames import (
    FRAME,
    REASON,
    decode_changes,
    decode_topic,
    envelope_ddl,
    unwrap_change,
    unwrap_flat,
)
from tidemark.functions.keys import with_business_key
from tidemark.functions.naming import changes_name, flat_name, history_name, quarantine_name, scd2_name
from tidemark.operators.sizing import measure
from tidemark.plans.history_step import HistoryReport, append_rows, apply_history_batch
from tidemark.plans.merge_into import MERGE_FORMATS
from tidemark.plans.partitions import Delivery
from tidemark.plans.scd2_step import Scd2Report, apply_scd2_batch
from tidemark.sources.tables import (
    TableRef,
    create_changes_table,
    create_history_table,
    create_scd2_table,
    create_table,
    ensure_database,
)

# Batch interval, and rows shown of a batch.
TRIGGER_INTERVAL = "300 seconds"
PREVIEW_ROWS = 20


@dataclass(frozen=True)
class FeedTables:
    history: TableRef
    scd2: TableRef | None = None
    changes: TableRef | None = None  # all changes as they came, for ``by_time``
    bad: TableRef | None = None  # messages that could not be decoded, with ``quarantine``


BAD_DDL = "value BINARY, topic STRING, partition INT, offset BIGINT, reason STRING"


def change_rows(frames: DataFrame, feed: CdcFeed) -> DataFrame:
    """Topic rows to normalised change rows with the business key.

    With ``quarantine`` rows of messages that could not be decoded are among them; :func:`split_bad` parts them.
    """
    extra = (REASON, FRAME) if feed.quarantine else ()
    if feed.schemas or feed.quarantine:
        decoded = decode_changes(frames, feed.after_ddl, dict(feed.schemas), feed.carry, feed.quarantine)
    else:
        schema = feed.avro_schema or envelope_ddl(feed.after_ddl)
        decoded = decode_topic(frames, schema, feed.payload_format, feed.carry)
    rows = unwrap_change(
        decoded,
        (*feed.transport, *extra),
        feed.partition_col,
        feed.partition_in_millis,
        feed.delete_image,
    )
    return with_business_key(rows, feed.key_cols, feed.key_sep)


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(change rows, messages that could not be decoded) of a feed with ``quarantine``."""
    bad = rows.where(F.col(REASON).isNotNull()).select(f"{FRAME}.*", F.col(REASON).alias("reason"))
    return rows.where(F.col(REASON).isNull()).drop(REASON, FRAME), bad


def flat_rows(frames: DataFrame, feed: FlatFeed) -> DataFrame:
    schema = feed.avro_schema or feed.record_ddl
    return unwrap_flat(decode_topic(frames, schema, feed.payload_format))


def _ensure_parent(spark: SparkSession, name: str, root: str) -> None:
    database, _, _ = name.rpartition(".")
    if database:
        ensure_database(spark, database, f"{root}/{database}")


def prepare_tables(spark: SparkSession, rows: DataFrame, feed: CdcFeed, root: str) -> FeedTables:
    """The tables of a change feed, created below ``root`` if absent."""
    rows = rows.drop(REASON, FRAME)
    schema = rows.drop(*feed.transport).schema
    hist, scd2 = history_name(feed.topic), scd2_name(feed.topic)
    _ensure_parent(spark, hist, root)
    every = None
    if feed.rules.by_time:
        name = changes_name(feed.topic)
        every = create_changes_table(spark, name, rows.schema, feed.order_cols, f"{root}/{name}")
    return FeedTables(
        history=create_history_table(
            spark, hist, schema, feed.history_partition, f"{root}/{hist}", feed.table_format
        ),
        scd2=create_scd2_table(
            spark, scd2, schema, feed.scd2_partition, f"{root}/{scd2}", feed.table_format, feed.key_buckets,
            feed.split_active,
        ),
        changes=every,
        bad=_bad_table(spark, feed, root) if feed.quarantine else None,
    )


def _bad_table(spark: SparkSession, feed: CdcFeed, root: str) -> TableRef:
    name = quarantine_name(feed.topic)
    return create_table(spark, name, BAD_DDL, f"{root}/{name}")


def prepare_flat_table(
    spark: SparkSession, rows: DataFrame, feed: FlatFeed, root: str, name: str | None = None
) -> FeedTables:
    name = name or flat_name(feed.topic)
    _ensure_parent(spark, name, root)
    table = create_history_table(
        spark, name, rows.schema, "ds", f"{root}/{name}", feed.table_format
    )
    return FeedTables(history=table)


def apply_change_batch(
    spark: SparkSession,
    batch: DataFrame,
    feed: CdcFeed,
    tables: FeedTables,
    delivery: Delivery | None = None,
) -> tuple[HistoryReport, Scd2Report]:
    """History first, then the versioned table; the batch is decoded once.

    ``delivery`` counts with ``batch_ledger`` only. Returns what happened to each table. With ``quarantine``
    messages that could not be decoded are kept first.
    """
    delivery = delivery if feed.batch_ledger else None
    decoded = batch = batch.persist()
    try:
        if feed.quarantine:
            batch, bad = split_bad(decoded)
            append_rows(spark, bad, tables.bad, delivery)
        size = measure(batch)
        appended = apply_history_batch(
            spark,
            batch,
            tables.history,
            feed.transport,
            feed.key_cols,
            feed.rules,
            feed.broadcast_bytes,
            size,
            delivery,
        )
        return appended, apply_scd2_batch(spark, batch, tables.scd2, feed, delivery, tables.changes)
    finally:
        decoded.unpersist()


def apply_flat_batch(
    spark: SparkSession,
    batch: DataFrame,
    feed: FlatFeed,
    tables: FeedTables,
    delivery: Delivery | None = None,
) -> HistoryReport:
    batch = batch.persist()
    try:
        return apply_history_batch(
            spark,
            batch,
            tables.history,
            key_cols=feed.key_cols,
            rules=feed.rules,
            broadcast_bytes=feed.broadcast_bytes,
            delivery=delivery,
        )
    finally:
        batch.unpersist()


def _start(
    rows: DataFrame,
    name: str,
    checkpoint: str | None,
    on_batch: Callable[[DataFrame, int], None],
    trigger: dict | None,
) -> StreamingQuery:
    writer = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
        .foreachBatch(on_batch)
    )
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()


def _query_id(session: SparkSession) -> str:
    """Id of the streaming query whose batch runs in this thread, as kept in its checkpoint."""
    found = session.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not inside a streaming batch")
    return found


def check_settings(feed: CdcFeed, checkpoint: str | None) -> None:
    """Refuse settings that do not go together."""
    if feed.batch_ledger and not checkpoint:
        raise ValueError("batch_ledger needs a checkpoint")
    settings = {
        "batch_ledger": feed.batch_ledger,
        "every_change": feed.rules.every_change,
        "split_active": feed.split_active,
    }
    for setting, wanted in settings.items():
        if wanted and feed.table_format in MERGE_FORMATS:
            raise ValueError(f"{setting} is not for {feed.table_format} tables")


def start_change_feed(
    spark: SparkSession,
    frames: DataFrame,
    feed: CdcFeed,
    root: str,
    checkpoint: str | None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start one change feed. Without a checkpoint a restart replays the whole topic.

    The ledger goes by the id in the checkpoint, so it needs one; a new checkpoint starts anew.
    """
    check_settings(feed, checkpoint)
    rows = change_rows(frames, feed)
    tables = prepare_tables(spark, rows, feed, root)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        delivery = Delivery(_query_id(session), batch_id) if feed.batch_ledger else None
        apply_change_batch(session, batch, feed, tables, delivery)

    return _start(rows, feed.topic, checkpoint, on_batch, trigger)


def start_flat_feed(
    spark: SparkSession,
    frames: DataFrame,
    feed: FlatFeed,
    root: str,
    checkpoint: str | None,
    trigger: dict | None = None,
    table_name: str | None = None,
) -> StreamingQuery:
    rows = flat_rows(frames, feed)
    tables = prepare_flat_table(spark, rows, feed, root, table_name)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply_flat_batch(batch.sparkSession, batch, feed, tables)

    return _start(rows, feed.topic, checkpoint, on_batch, trigger)


def start_feeds(
    spark: SparkSession,
    feeds: Iterable[CdcFeed | FlatFeed],
    source: Callable[[CdcFeed | FlatFeed], DataFrame],
    root: str,
    checkpoint_root: str | None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """An independent query per topic; for a repeated topic the first entry counts.

    Each query has its own scheduler pool: with ``spark.scheduler.mode=FAIR`` a
    feed that replays a long topic does not hold up the others.
    """
    first = {}
    for feed in feeds:
        first.setdefault(feed.topic, feed)
    queries: list[StreamingQuery] = []
    try:
        for topic, feed in first.items():
            start = start_change_feed if isinstance(feed, CdcFeed) else start_flat_feed
            checkpoint = f"{checkpoint_root}/{topic}" if checkpoint_root else None
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", topic)
            queries.append(start(spark, source(feed), feed, root, checkpoint, trigger))
    except BaseException:
        # All or none: a feed that cannot start takes those before it along.
        for query in queries:
            query.stop()
        raise
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    return queries


def await_any(spark: SparkSession, timeout: int | None = None) -> None:
    """Block until any query ends (one failed feed ends the wait for all)."""
    spark.streams.awaitAnyTermination(timeout)


def preview_rows(batch: DataFrame, n: int = PREVIEW_ROWS, order: Iterable[str] = ()) -> DataFrame:
    """First rows of a batch; with an order the choice is determined."""
    order = list(order)
    return (batch.orderBy(*order) if order else batch).limit(n)


def start_preview(
    rows: DataFrame,
    name: str | None = None,
    n: int = PREVIEW_ROWS,
    emit: Callable[[DataFrame], None] = lambda df: df.show(truncate=False),
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Show the first rows of every batch."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        emit(preview_rows(batch, n))

    return _start(rows, name or "preview", checkpoint, on_batch, trigger)


def table_count(spark: SparkSession, table: TableRef) -> DataFrame:
    """Row count of a table (answered from file footers, no column is read)."""
    return spark.table(table.sql_name).agg(F.count(F.lit(1)).alias("rows"))
