"""One streaming query for many topics: the source is read once, and each topic's rows go to its own tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.util import inheritable_thread_target

from tidemark.config import CdcFeed, FlatFeed
from tidemark.plans.history_step import HistoryReport
from tidemark.plans.partitions import Delivery
from tidemark.plans.scd2_step import Scd2Report
from tidemark.streaming.feeds import (
    FeedTables,
    _query_id,
    _start,
    apply_change_batch,
    apply_flat_batch,
    change_rows,
    check_settings,
    flat_rows,
    prepare_flat_table,
    prepare_tables,
)

TOPICS_AT_ONCE = 4

Reports = tuple[HistoryReport, Scd2Report | None]


class TopicsFailed(RuntimeError):
    """Some topics of a batch could not be applied; ``errors`` has why, by topic. The others were."""

    def __init__(self, errors: Mapping[str, BaseException]):
        super().__init__("; ".join(f"{topic}: {error}" for topic, error in errors.items()))
        self.errors = dict(errors)


def _apply(
    spark: SparkSession, frames: DataFrame, feed: CdcFeed | FlatFeed, tables: FeedTables, delivery: Delivery
) -> Reports:
    if isinstance(feed, CdcFeed):
        return apply_change_batch(spark, change_rows(frames, feed), feed, tables, delivery)
    return apply_flat_batch(spark, flat_rows(frames, feed), feed, tables, delivery), None


def apply_topics(
    spark: SparkSession,
    frames: DataFrame,
    feeds: Mapping[str, CdcFeed | FlatFeed],
    tables: Mapping[str, FeedTables],
    delivery: Delivery,
    at_once: int = TOPICS_AT_ONCE,
) -> dict[str, Reports]:
    """Apply a batch of several topics, each on its own; topics without rows cost nothing.

    A topic that fails does not keep the others from being applied: they are all tried, then
    :class:`TopicsFailed` tells which ones failed. When the batch is delivered again, those that were applied
    are skipped by their ledgers. A message of a topic that has no feed fails the batch before any is applied.
    """
    frames = frames.persist()
    try:
        # One more than there are feeds, if that many: then one of them has none.
        arrived = {r["topic"] for r in frames.select("topic").distinct().limit(len(feeds) + 1).collect()}
        if unknown := sorted(map(str, arrived - feeds.keys())):
            raise ValueError(f"no feed for topic {', '.join(unknown)}")

        def one(topic: str) -> Reports:
            # With spark.scheduler.mode=FAIR a long topic does not hold up the others.
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", topic)
            return _apply(spark, frames.where(F.col("topic") == topic), feeds[topic], tables[topic], delivery)

        # Job group and description of the batch go along, so that stopping the query stops these jobs too.
        with ThreadPoolExecutor(at_once) as pool:
            running = {t: pool.submit(inheritable_thread_target(spark)(one), t) for t in sorted(arrived)}
        errors = {t: error for t, job in running.items() if (error := job.exception()) is not None}
        if errors:
            raise TopicsFailed(errors) from next(iter(errors.values()))
        return {t: job.result() for t, job in running.items()}
    finally:
        frames.unpersist()


def start_shared_feed(
    spark: SparkSession,
    frames: DataFrame,
    feeds: Iterable[CdcFeed | FlatFeed],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str = "feeds",
    flat_tables: Mapping[str, str] | None = None,
    at_once: int = TOPICS_AT_ONCE,
) -> StreamingQuery:
    """One query over a source that holds all topics; for a repeated topic the first entry counts.

    All topics share offsets and batches, so a failed one is retried together with those that were applied:
    change feeds need ``batch_ledger``, and the query a checkpoint. ``flat_tables`` names the tables of flat
    topics, as ``table_name`` does for a feed of its own.
    """
    first: dict[str, CdcFeed | FlatFeed] = {}
    for feed in feeds:
        first.setdefault(feed.topic, feed)
    if not checkpoint:
        raise ValueError("topics that share a source need a checkpoint")
    tables = {}
    for topic, feed in first.items():
        if isinstance(feed, CdcFeed):
            if not feed.batch_ledger:
                raise ValueError(f"{topic}: topics that share a source need batch_ledger")
            check_settings(feed, checkpoint)
    for topic, feed in first.items():
        if isinstance(feed, CdcFeed):
            tables[topic] = prepare_tables(spark, change_rows(frames, feed), feed, root)
        else:
            named = (flat_tables or {}).get(topic)
            tables[topic] = prepare_flat_table(spark, flat_rows(frames, feed), feed, root, named)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        apply_topics(session, batch, first, tables, Delivery(_query_id(session), batch_id), at_once)

    return _start(frames, name, checkpoint, on_batch, trigger)
