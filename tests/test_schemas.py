"""Frames that name their schema, messages that fit none, and columns that appear later."""

import sys
import types

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import feed, rows, tables
from tidemark.config import CdcFeed
from tidemark.functions import frames as wire
from tidemark.plans.partitions import Delivery
from tidemark.sources.tables import create_history_table, create_scd2_table
from tidemark.sources.topics import read_kafka_topic
from tidemark.streaming.feeds import apply_change_batch, change_rows, prepare_tables, split_bad, start_change_feed

SCHEMAS = ((3, "id INT, price STRING"), (300, "id BIGINT, price STRING, name STRING, more DOUBLE"))
GOOD = '{"after": {"id": 5, "price": "9", "name": "n", "more": 1.5}, "op": "c", "source": {"ts_ms": 1704067200000}}'


def message(number, text):
    return None if text is None else bytes([0]) + number.to_bytes(4, "big") + text.encode()


def topic(spark, *messages):
    made = [(m, "t", 0, k) for k, m in enumerate(messages)]
    return spark.createDataFrame(made, "value BINARY, topic STRING, partition INT, offset BIGINT")


def test_each_message_by_its_own_schema(spark):
    got = change_rows(topic(spark, message(3, GOOD), message(300, GOOD), message(3, None)), feed(schemas=SCHEMAS)).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == [(5, "9", "n", "c"), (5, "9", None, "c"), (None, None, None, None)]


@pytest.mark.parametrize("bad, reason", [
    (message(4, GOOD), "unknown schema id 4"),
    (b"\x00\x00\x01", "frame too short"),
    (message(3, GOOD[:-20]), "payload does not fit its schema"),
    (message(3, GOOD.replace("5", '"five"', 1)), "payload does not fit its schema"),
])
def test_a_message_that_fits_no_schema(spark, bad, reason):
    """Fails the batch, or is kept with its place and the reason."""
    every = topic(spark, message(3, GOOD), bad)
    with pytest.raises(Exception, match=reason):
        change_rows(every, feed(schemas=SCHEMAS)).collect()
    good, kept = split_bad(change_rows(every, feed(schemas=SCHEMAS, quarantine=True)))
    assert [r["id"] for r in good.collect()] == [5]
    assert [(r["topic"], r["partition"], r["offset"], r["reason"], bytes(r["value"])) for r in kept.collect()] == [("t", 0, 1, reason, bad)]


def test_quarantine_without_schema_ids(spark):
    every = topic(spark, message(3, GOOD), message(9, "{"), message(1, None))
    good, kept = split_bad(change_rows(every, feed(quarantine=True)))
    assert (good.count(), kept.count()) == (2, 1)


def test_bad_messages_are_kept_once(spark, tmp_path):
    a_feed = feed(quarantine=True, batch_ledger=True)
    decoded = change_rows(topic(spark, message(3, GOOD), message(9, "{")), a_feed)
    made = prepare_tables(spark, decoded, a_feed, str(tmp_path))
    for _ in range(2):
        apply_change_batch(spark, decoded, a_feed, made, Delivery("q", 0))
    assert [spark.table(t.sql_name).count() for t in (made.bad, made.history, made.scd2)] == [1, 1, 1]


def test_a_stream_goes_on_past_a_bad_message(spark, tmp_path):
    frames = topic(spark, message(3, GOOD), message(9, "{")).withColumn("timestamp", F.lit(None).cast("timestamp"))
    frames.write.parquet(f"{tmp_path}/topic")
    a_feed = feed(quarantine=True)
    read = spark.readStream.schema(frames.schema).parquet(f"{tmp_path}/topic")
    start_change_feed(spark, read, a_feed, str(tmp_path), f"{tmp_path}/checkpoint", {"availableNow": True}).awaitTermination()
    made = prepare_tables(spark, change_rows(frames, a_feed), a_feed, str(tmp_path))
    assert [spark.table(t.sql_name).count() for t in (made.bad, made.history)] == [1, 1]


def test_schemas_that_would_be_narrowed_are_refused(spark):
    with pytest.raises(ValueError, match="id is string"):
        change_rows(topic(spark), feed(schemas=((3, "id STRING"),)))
    with pytest.raises(ValueError, match="JSON"):
        feed(schemas=SCHEMAS, payload_format="avro")
    assert wire.widens(T.IntegerType(), T.LongType()) and not wire.widens(T.LongType(), T.IntegerType())
    assert wire.widens(T.IntegerType(), T.DoubleType()) and not wire.widens(T.LongType(), T.DoubleType())


def test_tables_take_new_columns_and_refuse_narrowing(spark, tmp_path):
    a_feed = feed()
    first = rows(spark, (1, "10", "a", "c", 1)).drop("_offset")
    made = tables(spark, first, a_feed, tmp_path)
    wider = first.withColumn("extra", F.lit(1))
    for table, create in ((made.history, create_history_table), (made.scd2, create_scd2_table)):
        create(spark, table.name, wider.schema, table.partition_col, table.location)
        create(spark, table.name, wider.schema, table.partition_col, table.location)  # nothing left to add
        assert "extra" in spark.table(table.sql_name).columns
        with pytest.raises(ValueError, match="extra is int"):
            create(spark, table.name, first.withColumn("extra", F.lit("x")).schema, table.partition_col, table.location)
        with pytest.raises(ValueError, match="has a column extra"):
            create(spark, table.name, first.schema, table.partition_col, table.location)


def test_avro_payloads_go_to_the_package(spark, monkeypatch):
    """Which schema text and which bytes it is handed, where the package is loaded."""
    seen = []

    def from_avro(payload, schema, options=None):
        seen.append((schema, options))
        return F.from_json(F.decode(payload, "UTF-8"), wire.envelope_ddl("id BIGINT"))

    module = types.ModuleType("pyspark.sql.avro.functions")
    module.from_avro = from_avro
    monkeypatch.setitem(sys.modules, "pyspark.sql.avro.functions", module)
    a_feed = feed(after_ddl="id BIGINT", payload_format="avro", avro_schema='{"type": "record"}')
    got = change_rows(topic(spark, message(3, GOOD), message(3, None)), a_feed).collect()
    assert sorted(((r["id"], r["op_type"]) for r in got), key=repr) == [(5, "c"), (None, None)]
    assert seen == [('{"type": "record"}', None)]


def test_kafka_without_its_package_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_topic(spark, "host:9092", "t")


def test_feeds_are_values():
    assert CdcFeed("t", "id INT", ("id",)) == CdcFeed("t", "id INT", ("id",))
