"""Registered queries: each runs the library over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import BOOKKEEPING, JOIN_KEY, KEY_BUCKET, TIMELINE, CdcFeed, MergeRules
from tidemark.functions.frames import (
    date_from_days,
    date_from_millis,
    decode_topic,
    envelope_ddl,
    unwrap_change,
    unwrap_change_raw_time,
)
from tidemark.functions.keys import (
    columns_except,
    drop_bookkeeping,
    key_first,
    overwrite_columns,
    with_business_key,
)
from tidemark.functions.naming import base_name_column, scd2_name
from tidemark.operators.latest import latest_per_key
from tidemark.operators.sizing import measure
from tidemark.operators.staging import changed_keys, staged_updates
from tidemark.plans.history_step import apply_history_batch
from tidemark.plans.partitions import Delivery
from tidemark.plans.scd2_step import apply_scd2_batch, newest_changes
from tidemark.session import run_dir, run_id
from tidemark.sources.tables import (
    TableRef,
    active_rows,
    create_table,
    ensure_database,
    open_table,
    query_table,
)
from tidemark.sources.topics import (
    read_topic_files,
    scan_csv,
    scan_topic_files,
    write_topic_files,
)
from tidemark.streaming.feeds import (
    FeedTables,
    apply_change_batch,
    apply_flat_batch,
    change_rows,
    flat_rows,
    prepare_flat_table,
    prepare_tables,
    preview_rows,
    start_change_feed,
    start_feeds,
    table_count,
)
from tidemark.streaming.shared import start_shared_feed
from tidemark.workload import inputs

BATCHES = (1, 2, 3)
EVENT_PAYLOAD = ("user_id", "tier", "event_type")


# Decoding and scalar transforms -------------------------------------------------


def frame_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").drop("ts")
    ts = inputs.table(spark, sf_dir, "events")
    frames = inputs.change_frames(
        ts,
        rows.columns,
        F.col("ts"),
        inputs.op_code(F.col("event_type")),
        F.col("event_id"),
        "app.dbo.events",
    )
    ddl = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    return unwrap_change(decode_topic(frames, envelope_ddl(ddl)))


def unwrap_raw_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = inputs.event_frames(spark, sf_dir, "app.dbo.events")
    decoded = decode_topic(frames, envelope_ddl(inputs.EVENTS_DDL), carry=(("offset", "event_id"),))
    return unwrap_change_raw_time(decoded, ["event_id"])


def partition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("millis"),
        F.unix_date(F.to_date("o_orderdate")).alias("days"),
    )
    return orders.select(
        "o_orderkey",
        date_from_millis(F.col("millis")).alias("from_millis"),
        date_from_days(F.col("days")).alias("from_days"),
    )


def _dated_frames(spark: SparkSession, sf_dir: str, millis: bool) -> DataFrame:
    """Order changes whose payload has the order date encoded one way or the other."""
    at = F.col("o_orderdate").cast("timestamp")
    encoded = F.unix_millis(at) if millis else F.unix_date(F.to_date("o_orderdate"))
    rows = inputs.table(spark, sf_dir, "orders").withColumn("day", encoded.cast("bigint"))
    columns = ["o_orderkey", "o_orderstatus", "day"]
    return inputs.change_frames(rows, columns, F.col("o_orderdate"), F.lit("u"), F.col("o_orderkey"), "t")


def envelope_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition date out of the envelope: milliseconds for one kind of topic, days for the other."""
    ddl = "o_orderkey BIGINT, o_orderstatus STRING, day BIGINT"
    parts = []
    for topic in ("dna.dbo.orders", "app.dbo.orders"):
        feed = inputs.events_feed(topic=topic, after_ddl=ddl, key_cols=("o_orderkey",), partition_col="day")
        rows = change_rows(_dated_frames(spark, sf_dir, feed.partition_in_millis), feed)
        parts.append(rows.select(F.lit(topic).alias("topic"), "o_orderkey", "day", "day_PARTITION", JOIN_KEY, "ds"))
    return reduce(DataFrame.unionByName, parts)


def delete_before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes without an after-image take key and payload from the old one."""
    feed = inputs.events_feed(delete_image="before")
    return change_rows(inputs.event_frames(spark, sf_dir, feed.topic, old_image=True), feed)


def key_separator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key parts behind a separator, through the envelope."""
    feed = inputs.events_feed(
        after_ddl="l_orderkey BIGINT, l_linenumber INT", key_cols=("l_orderkey", "l_linenumber"), key_sep="|"
    )
    lines = inputs.table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_linenumber"]
    frames = inputs.change_frames(lines, columns, F.col("l_shipdate"), F.lit("c"), F.col("l_orderkey"), feed.topic)
    return change_rows(frames, feed).drop("_offset")


def join_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
    )
    return with_business_key(rows, ["l_orderkey", "l_linenumber", "flag"])


def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.concat_ws(".", "o_orderpriority", F.lit("dbo"), "o_orderstatus", "o_orderkey")
    rows = inputs.table(spark, sf_dir, "orders").select(topic.alias("topic"))
    base = base_name_column(F.col("topic"))
    return rows.select(
        "topic",
        F.concat(base, F.lit("_scd2")).alias("scd2_table"),
        F.concat(base, F.lit("_hist")).alias("hist_table"),
    )


def latest_per_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.to_date("l_shipdate").alias("ds"),
    )
    return latest_per_key(
        rows,
        ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"],
        key=["l_orderkey", "l_linenumber"],
    )


# Tables built batch by batch ----------------------------------------------------


def _workspace(spark: SparkSession) -> tuple[str, str]:
    """(folder below the shared folder, database-safe name) of this run."""
    rid = run_id()
    return run_dir(spark, "query", rid), f"tm_{rid}"


def _event_tables(
    spark: SparkSession, rows: DataFrame, **settings
) -> tuple[inputs.CdcFeed, FeedTables]:
    root, name = _workspace(spark)
    feed = inputs.events_feed(topic=f"{name}.dbo.events", **settings)
    return feed, prepare_tables(spark, rows.drop("batch_no"), feed, root)


def _events_scd2(
    spark: SparkSession,
    sf_dir: str,
    batches: tuple[int | tuple[int, ...], ...] = BATCHES,
    nulls: bool = False,
    day: bool = False,
    **settings,
) -> tuple[inputs.CdcFeed, TableRef, DataFrame]:
    """Fold the event batches into a fresh versioned table."""
    changes = inputs.event_changes(spark, sf_dir, nulls=nulls, day=day)
    feed, tables = _event_tables(spark, changes, **settings)
    for number in batches:
        delivery = Delivery("events", number) if isinstance(number, int) else None
        apply_scd2_batch(spark, inputs.event_batch(changes, number), tables.scd2, feed, delivery, tables.changes)
    return feed, tables.scd2, changes


def _rows(spark: SparkSession, table: TableRef) -> DataFrame:
    return spark.table(table.sql_name)


def scd2_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table, _ = _events_scd2(spark, sf_dir)
    return _rows(spark, table)


def scd2_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for a batch too big to broadcast, with keys of three versions and more salted."""
    _, table, _ = _events_scd2(spark, sf_dir, broadcast_bytes=0, hot_versions=3)
    return _rows(spark, table)


def scd2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second partition level by key: merges rewrite date x bucket."""
    _, table, _ = _events_scd2(spark, sf_dir, key_buckets=4)
    return _rows(spark, table).drop(KEY_BUCKET)


def scd2_scd_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payload columns versioned, nothing overwritten."""
    _, table, _ = _events_scd2(spark, sf_dir, scd_cols=("tier", "event_type"))
    return _rows(spark, table)


def scd2_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No versioned column: close deleted keys, overwrite the rest."""
    _, table, _ = _events_scd2(spark, sf_dir, scd_cols=())
    return _rows(spark, table)


def active_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table, _ = _events_scd2(spark, sf_dir)
    return active_rows(spark, table.name)


def active_split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table that keeps active and closed versions in files of their own."""
    _, table, _ = _events_scd2(spark, sf_dir, split_active=True)
    return active_rows(spark, table.name)


def scd2_null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table, _ = _events_scd2(spark, sf_dir, nulls=True)
    return _rows(spark, table)


def scd2_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table, _ = _events_scd2(spark, sf_dir, nulls=True, rules=MergeRules(null_safe=True))
    return _rows(spark, table)


def scd2_honor_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table, _ = _events_scd2(spark, sf_dir, rules=MergeRules(honor_deletes=True))
    return _rows(spark, table)


def scd2_reopen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = MergeRules(honor_deletes=True, reopen=True)
    _, table, _ = _events_scd2(spark, sf_dir, rules=rules)
    return _rows(spark, table)


def scd2_active_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table, _ = _events_scd2(spark, sf_dir, rules=MergeRules(active_only_overwrite=True))
    return _rows(spark, table)


def scd2_all_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of the three batches counts, not the newest of a key alone."""
    _, table, _ = _events_scd2(spark, sf_dir, rules=TIMELINE)
    return _rows(spark, table)


def scd2_all_changes_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes in one batch, with nulls and by shuffle; keys of five changes and more day by day."""
    _, table, _ = _events_scd2(spark, sf_dir, ((1, 2, 3),), nulls=True, rules=TIMELINE, broadcast_bytes=0, hot_versions=5)
    return _rows(spark, table)


def scd2_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches in the order 3, 1, 2: late changes split the versions that cover them."""
    _, table, _ = _events_scd2(spark, sf_dir, (3, 1, 2), nulls=True, rules=replace(TIMELINE, by_time=True))
    return _rows(spark, table)


def scd2_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned by a payload date, which is overwritten in place: rows move."""
    _, table, _ = _events_scd2(
        spark, sf_dir, day=True, after_ddl=inputs.EVENTS_DAY_DDL, partition_col="day"
    )
    return _rows(spark, table)


def scd2_replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch delivered twice: the second pass closes re-inserted deletes."""
    _, table, _ = _events_scd2(spark, sf_dir, batches=(1, 2, 3, 3))
    return _rows(spark, table)


def scd2_batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same double delivery with the ledger on: the repeat is skipped."""
    _, table, _ = _events_scd2(spark, sf_dir, batches=(1, 2, 3, 3), batch_ledger=True)
    return _rows(spark, table)


def delete_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of delete rows: active versions born of a delete, closed keys never reopened."""
    _, table, _ = _events_scd2(spark, sf_dir)
    state = _rows(spark, table)
    per_key = state.groupBy(JOIN_KEY).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("ActiveIndicator")).alias("active_versions"),
        F.count_if(F.col("ActiveIndicator") & (F.col("Action") == "d")).alias("active_deletes"),
        F.count_if(~F.col("ActiveIndicator") & (F.col("Action") == "d")).alias("closed_by_delete"),
        F.max("EffectiveDate").alias("last_effective"),
        F.max("EndDate").alias("last_end"),
    )
    return per_key


def scd2_changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, table, changes = _events_scd2(spark, sf_dir, batches=(1, 2))
    newest = newest_changes(inputs.event_batch(changes, 3), feed)
    small = measure(newest).within(feed.broadcast_bytes)
    return changed_keys(newest, _rows(spark, table), feed.scd_cols, small=small)


def scd2_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, table, changes = _events_scd2(spark, sf_dir, batches=(1, 2))
    newest = newest_changes(inputs.event_batch(changes, 3), feed)
    small = measure(newest).within(feed.broadcast_bytes)
    return staged_updates(newest, _rows(spark, table), feed.scd_cols, small=small)


def partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-set helpers and a pruned read of a table partitioned by a payload date."""
    changes = inputs.event_changes(spark, sf_dir, day=True)
    feed, tables = _event_tables(
        spark, changes, after_ddl=inputs.EVENTS_DAY_DDL, partition_col="day"
    )
    rows = changes.drop("batch_no")
    apply_history_batch(spark, rows, tables.history, feed.transport, feed.key_cols)
    stored = spark.table(open_table(spark, tables.history.name).sql_name)
    days = F.col("day_PARTITION").between("2024-01-08", "2024-01-14")
    keyed = key_first(with_business_key(stored.where(days), feed.key_cols))
    payload = drop_bookkeeping(keyed).columns
    overwritten = overwrite_columns(keyed.columns, feed.scd_cols, feed.key_cols)
    versioned = columns_except(payload, [*overwritten, JOIN_KEY])
    return keyed.select(
        JOIN_KEY,
        *[F.col(c).alias(f"key_or_scd_{c}") for c in versioned],
        *[F.col(c).alias(f"overwritten_{c}") for c in overwritten],
        *[c for c in BOOKKEEPING if c in keyed.columns],
    )


# History ------------------------------------------------------------------------


def _events_history(
    spark: SparkSession, sf_dir: str, steps: tuple[tuple[int, ...], ...], nulls: bool = False,
    **settings,
) -> TableRef:
    changes = inputs.event_changes(spark, sf_dir, nulls=nulls)
    feed, tables = _event_tables(spark, changes, **settings)
    for numbers in steps:
        batch = changes.where(F.col("batch_no").isin(*numbers)).drop("batch_no")
        apply_history_batch(
            spark,
            batch,
            tables.history,
            feed.transport,
            feed.key_cols,
            feed.rules,
            feed.broadcast_bytes,
        )
    return tables.history


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, _events_history(spark, sf_dir, ((1,), (2,), (3,))))


def history_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As for batches too big to broadcast."""
    table = _events_history(spark, sf_dir, ((1,), (2,), (3,)), broadcast_bytes=0)
    return _rows(spark, table)


def history_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First batch, then the whole topic again, with nulls: null rows come in twice."""
    return _rows(spark, _events_history(spark, sf_dir, ((1,), (1, 2, 3)), nulls=True))


def history_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch delivered twice, with nulls: staged, noted and moved in once."""
    changes = inputs.event_changes(spark, sf_dir, nulls=True)
    feed, tables = _event_tables(spark, changes, batch_ledger=True)
    for number, batches in ((0, (1,)), (1, BATCHES), (1, BATCHES)):
        apply_history_batch(
            spark, inputs.event_batch(changes, batches), tables.history, feed.transport, feed.key_cols, delivery=Delivery("events", number)
        )
    return _rows(spark, tables.history)


def history_replay_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _events_history(
        spark, sf_dir, ((1,), (1, 2, 3)), nulls=True, rules=MergeRules(null_safe=True)
    )
    return _rows(spark, table)


def history_upper_case_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key configured in another case than the column has."""
    table = _events_history(spark, sf_dir, ((1,), (1, 2), (3,)), key_cols=("USER_ID",))
    return _rows(spark, table)


def history_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _events_history(spark, sf_dir, ((1,), (2,), (3,)))
    return spark.sql(
        "SELECT ds, op_type, count(*) AS n, count(DISTINCT user_id) AS users "
        f"FROM {table.sql_name} GROUP BY ds, op_type"
    )


def flat_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping spans of ``orders`` as framed flat messages."""
    root, name = _workspace(spark)
    feed = inputs.orders_feed(f"{name}.dbo.orders")
    orders = inputs.table(spark, sf_dir, "orders")
    spans = (orders.where("o_orderdate < '1998-07-01'"), orders.where("o_orderdate >= '1997-01-01'"))
    tables = None
    for span in spans:
        rows = flat_rows(inputs.flat_frames(span, feed.topic, F.col("o_orderkey")), feed)
        tables = tables or prepare_flat_table(spark, rows, feed, root, f"{name}.fso_orders")
        apply_flat_batch(spark, rows, feed, tables)
    stored = _rows(spark, tables.history).drop("ds")
    return stored.withColumn("o_orderdate", F.to_date("o_orderdate"))


# Plain tables and files ---------------------------------------------------------


def explicit_schema_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in a table declared by DDL at a place of its own, read back by SQL."""
    root, name = _workspace(spark)
    ensure_database(spark, name, f"{root}/{name}")
    table = create_table(
        spark,
        f"{name}.order_lines",
        "l_orderkey BIGINT, l_linenumber INT, l_suppkey BIGINT, l_extendedprice DOUBLE, l_shipdate DATE",
        f"{root}/order_lines",
        comment="one row per order line",
    )
    inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate")
    ).write.insertInto(table.sql_name)
    return query_table(spark, table.name)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _workspace(spark)
    ddl = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
    orders = inputs.table(spark, sf_dir, "orders").drop("o_orderdate")
    orders.write.csv(f"{root}/orders_csv", header=True)
    return scan_csv(spark, f"{root}/orders_csv", ddl)


def preview_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.event_changes(spark, sf_dir).drop("batch_no")
    return preview_rows(rows, order=["_offset"])


# Schemas and messages that change ---------------------------------------------------


def schema_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two schemas in one topic, each decoded with its own."""
    feed = inputs.events_feed(schemas=inputs.TWO_SCHEMAS)
    return change_rows(inputs.two_schema_frames(spark, sf_dir, feed.topic), feed)


def columns_that_appear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose second schema has a column more: the tables get it, earlier rows hold null in it."""
    root, name = _workspace(spark)
    earlier = inputs.events_feed(topic=f"{name}.dbo.events", after_ddl="user_id BIGINT, tier STRING")
    later = inputs.events_feed(topic=earlier.topic)
    frames = inputs.event_frames(spark, sf_dir, earlier.topic)
    for number in BATCHES:
        feed = earlier if number == 1 else later
        rows = change_rows(frames.where(F.col("batch_no") == number).drop("batch_no"), feed)
        tables = prepare_tables(spark, rows, feed, root)
        apply_change_batch(spark, rows, feed, tables)
    return _rows(spark, tables.scd2)


def _damaged(spark: SparkSession, sf_dir: str) -> FeedTables:
    root, name = _workspace(spark)
    feed = inputs.events_feed(topic=f"{name}.dbo.events", schemas=inputs.TWO_SCHEMAS, quarantine=True, batch_ledger=True)
    rows = change_rows(inputs.damaged_frames(spark, sf_dir, feed.topic), feed)
    tables = prepare_tables(spark, rows, feed, root)
    for number in (0, 0):  # delivered twice
        apply_change_batch(spark, rows, feed, tables, Delivery("events", number))
    return tables


def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic with messages that cannot be decoded: the others reach the history table."""
    return _rows(spark, _damaged(spark, sf_dir).history)


def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """And those that cannot are kept with their place and the reason."""
    return _rows(spark, _damaged(spark, sf_dir).bad).select("partition", "offset", "reason")


# Streaming ----------------------------------------------------------------------


def _stream_events(
    spark: SparkSession, sf_dir: str, checkpoints: tuple[int, ...] = (1, 1, 1), **settings
) -> FeedTables:
    """Three deliveries to a file topic; after each, the feed goes on from the given checkpoint."""
    root, name = _workspace(spark)
    feed = inputs.events_feed(topic=f"{name}.dbo.events", **settings)
    frames = inputs.event_frames(spark, sf_dir, feed.topic)
    topic = f"{root}/topic"
    for number, checkpoint in zip(BATCHES, checkpoints, strict=True):
        write_topic_files(frames.where(F.col("batch_no") == number).drop("batch_no"), topic)
        query = start_change_feed(
            spark,
            read_topic_files(spark, topic),
            feed,
            root,
            f"{root}/checkpoint-{checkpoint}",
            {"availableNow": True},
        )
        query.awaitTermination()
    return prepare_tables(spark, change_rows(frames, feed), feed, root)


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, _stream_events(spark, sf_dir).scd2)


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, _stream_events(spark, sf_dir).history)


def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger on, and a fresh checkpoint after the first delivery: its first batch is the topic so far."""
    return _rows(spark, _stream_events(spark, sf_dir, (1, 2, 2), batch_ledger=True).scd2)


def two_change_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two change feeds side by side: events by user, orders by customer; their current states."""
    root, name = _workspace(spark)
    events = inputs.events_feed(topic=f"{name}.dbo.events")
    orders = inputs.order_changes_feed(topic=f"{name}.dbo.orders")
    frames = {
        events.topic: inputs.event_frames(spark, sf_dir, events.topic).drop("batch_no"),
        orders.topic: inputs.order_frames(spark, sf_dir, orders.topic),
    }
    for topic, rows in frames.items():
        write_topic_files(rows, f"{root}/{topic}")
    started = start_feeds(
        spark,
        [events, orders],
        lambda feed: read_topic_files(spark, f"{root}/{feed.topic}"),
        root,
        f"{root}/checkpoint",
        {"availableNow": True},
    )
    for query in started:
        query.awaitTermination()
    return _two_states(spark, events, orders)


def one_source_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two feeds by one query, over one source that holds both topics."""
    root, name = _workspace(spark)
    events = inputs.events_feed(topic=f"{name}.dbo.events", batch_ledger=True)
    orders = inputs.order_changes_feed(topic=f"{name}.dbo.orders", batch_ledger=True)
    source = f"{root}/topics"
    write_topic_files(inputs.event_frames(spark, sf_dir, events.topic).drop("batch_no"), source)
    write_topic_files(inputs.order_frames(spark, sf_dir, orders.topic), source)
    query = start_shared_feed(
        spark,
        read_topic_files(spark, source),
        [events, orders],
        root,
        f"{root}/checkpoint",
        {"availableNow": True},
        name,
    )
    query.awaitTermination()
    return _two_states(spark, events, orders)


def _two_states(spark: SparkSession, events: CdcFeed, orders: CdcFeed) -> DataFrame:
    parts = [
        active_rows(spark, scd2_name(feed.topic)).select(
            F.lit(label).alias("feed"), JOIN_KEY, F.col(feed.scd_cols[0]).alias("versioned"), "EffectiveDate"
        )
        for label, feed in (("events", events), ("orders", orders))
    ]
    return reduce(DataFrame.unionByName, parts)


def multi_feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed and a flat feed side by side; row counts per table afterwards."""
    root, name = _workspace(spark)
    changes = inputs.events_feed(topic=f"{name}.dbo.events")
    # The flat table name is the prefix plus the topic, so the topic has no dots.
    flat = inputs.orders_feed(f"orders_{name}")
    orders = inputs.table(spark, sf_dir, "orders")
    write_topic_files(
        inputs.event_frames(spark, sf_dir, changes.topic).drop("batch_no"), f"{root}/{changes.topic}"
    )
    write_topic_files(
        inputs.flat_frames(orders, flat.topic, F.col("o_orderkey")), f"{root}/{flat.topic}"
    )
    queries = start_feeds(
        spark,
        [changes, flat],
        lambda feed: read_topic_files(spark, f"{root}/{feed.topic}"),
        root,
        f"{root}/checkpoint",
        {"availableNow": True},
    )
    for query in queries:
        query.awaitTermination()
    change_tables = prepare_tables(
        spark, change_rows(scan_topic_files(spark, f"{root}/{changes.topic}"), changes), changes, root
    )
    flat_table = open_table(spark, f"fso.{flat.topic}")
    counted = {
        "events_hist": change_tables.history,
        "events_scd2": change_tables.scd2,
        "orders_flat": flat_table,
    }
    parts = [
        table_count(spark, table).select(F.lit(label).alias("feed_table"), "rows")
        for label, table in counted.items()
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "frame_roundtrip": frame_roundtrip,
    "unwrap_raw_time": unwrap_raw_time,
    "partition_dates": partition_dates,
    "envelope_partition_date": envelope_partition_date,
    "delete_before_image": delete_before_image,
    "key_separator": key_separator,
    "join_key": join_key,
    "table_names": table_names,
    "latest_per_key": latest_per_key_lineitem,
    "history_append": history_append,
    "history_shuffled": history_shuffled,
    "history_replay": history_replay,
    "history_ledger": history_ledger,
    "history_replay_null_safe": history_replay_null_safe,
    "history_upper_case_key": history_upper_case_key,
    "history_sql": history_sql,
    "flat_history": flat_history,
    "scd2_changed_keys": scd2_changed_keys,
    "scd2_staged": scd2_staged,
    "scd2_three_batches": scd2_three_batches,
    "scd2_shuffled": scd2_shuffled,
    "scd2_bucketed": scd2_bucketed,
    "scd2_scd_only": scd2_scd_only,
    "scd2_update_only": scd2_update_only,
    "scd2_null_default": scd2_null_default,
    "scd2_null_safe": scd2_null_safe,
    "scd2_honor_deletes": scd2_honor_deletes,
    "scd2_reopen": scd2_reopen,
    "scd2_active_only": scd2_active_only,
    "scd2_all_changes": scd2_all_changes,
    "scd2_all_changes_one_batch": scd2_all_changes_one_batch,
    "scd2_late_events": scd2_late_events,
    "scd2_partition_date": scd2_partition_date,
    "scd2_replayed_batch": scd2_replayed_batch,
    "scd2_batch_ledger": scd2_batch_ledger,
    "active_rows": active_state,
    "active_split_files": active_split_files,
    "delete_edge_cases": delete_edge_cases,
    "partitioned_read": partitioned_read,
    "explicit_schema_table": explicit_schema_table,
    "csv_scan": csv_scan,
    "preview_batch": preview_batch,
    "schema_ids": schema_ids,
    "columns_that_appear": columns_that_appear,
    "quarantine_good": quarantine_good,
    "quarantine_bad": quarantine_bad,
    "stream_history": stream_history,
    "stream_scd2": stream_scd2,
    "stream_new_checkpoint": stream_new_checkpoint,
    "two_change_feeds": two_change_feeds,
    "one_source_feeds": one_source_feeds,
    "multi_feed_counts": multi_feed_counts,
}
