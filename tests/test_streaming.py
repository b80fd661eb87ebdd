import json
import time

import pytest

from helpers import AFTER, feed, versions
from tidemark.config import FlatFeed
from tidemark.functions.naming import quoted, scd2_name
from tidemark.plans import history_step
from tidemark.plans.partitions import Delivery
from tidemark.sources.topics import (
    kafka_options,
    read_topic_files,
    scan_csv,
    scan_topic_files,
    write_topic_files,
)
from tidemark.sources.tables import create_table, query_table
from tidemark.streaming.feeds import (
    apply_change_batch,
    await_any,
    change_rows,
    prepare_tables,
    preview_rows,
    start_change_feed,
    start_feeds,
    start_preview,
)

NOW = {"availableNow": True}
DAY_MS = 86_400_000
TOPIC = "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def frames(spark, *changes, start=0):
    out = []
    for i, (key, price, name, op, d) in enumerate(changes):
        body = {
            "after": {"id": key, "price": price, "name": name},
            "op": op,
            "source": {"ts_ms": (19722 + d) * DAY_MS},
            "ts_ms": 0,
        }
        out.append((bytes(5) + json.dumps(body).encode(), "t", 0, start + i, None))
    return spark.createDataFrame(out, TOPIC)


BATCHES = (
    [(1, "10", "a", "c", 1), (2, "5", "a", "c", 1)],
    [(1, "20", "a", "u", 2), (2, "5", "b", "u", 2)],
    [(2, "5", "b", "d", 3)],
)


def run(spark, path, a_feed, root, checkpoint):
    query = start_change_feed(spark, read_topic_files(spark, path), a_feed, root, checkpoint, NOW)
    assert query.name == a_feed.topic
    query.awaitTermination()


def test_stream_equals_batches_and_resumes(spark, tmp_path):
    a_feed, folded = feed(), feed()
    path, root = str(tmp_path / "topic"), str(tmp_path)
    made = None
    for n, batch in enumerate(BATCHES):
        arrived = frames(spark, *batch, start=10 * n)
        write_topic_files(arrived, path)
        run(spark, path, a_feed, root, f"{root}/cp")
        rows = change_rows(arrived, folded)
        made = made or prepare_tables(spark, rows, folded, root)
        apply_change_batch(spark, rows, folded, made)
    streamed = spark.table(quoted(scd2_name(a_feed.topic)))
    expected = versions(spark.table(made.scd2.sql_name))
    assert versions(streamed) == expected and len(expected) == 3

    run(spark, path, a_feed, root, f"{root}/cp")  # nothing new
    assert versions(spark.table(quoted(scd2_name(a_feed.topic)))) == expected


def test_restart_without_checkpoint_replays_the_topic(spark, tmp_path):
    a_feed = feed()
    path, root = str(tmp_path / "topic"), str(tmp_path)
    for n, batch in enumerate(BATCHES[:2]):
        write_topic_files(frames(spark, *batch, start=10 * n), path)
    for _ in range(2):
        run(spark, path, a_feed, root, None)
    hist = spark.table(quoted(a_feed.topic.split(".")[0] + ".items_hist"))
    assert hist.count() == 4  # no nulls, so the replay adds nothing
    assert versions(spark.table(quoted(scd2_name(a_feed.topic)))) == [
        ("1", "20", "a", True, 2, None, "u"),
        ("2", "5", "b", True, 2, None, "u"),
    ]


def test_fan_out_one_query_per_topic(spark, tmp_path):
    first, repeated = feed(), None
    repeated = feed(topic=first.topic, scd_cols=("name",))
    flat = FlatFeed(topic=first.topic.split(".")[0] + "-flat", record_ddl=AFTER)
    root = str(tmp_path)
    write_topic_files(frames(spark, *BATCHES[0]), f"{root}/{first.topic}")
    body = bytes(5) + json.dumps({"id": 1, "price": "1", "name": "x"}).encode()
    write_topic_files(
        spark.createDataFrame([(body, "f", 0, 0, None)] * 2, TOPIC), f"{root}/{flat.topic}"
    )
    queries = start_feeds(
        spark, [first, flat, repeated], lambda f: read_topic_files(spark, f"{root}/{f.topic}"), root, f"{root}/cp", NOW
    )
    assert len(queries) == 2
    for query in queries:
        query.awaitTermination()
    assert len(versions(spark.table(quoted(scd2_name(first.topic))))) == 2
    flat_table = f"fso.{flat.topic.replace('-', '_')}"
    assert query_table(spark, flat_table, "count(*) AS n").first()["n"] == 2


def test_preview(spark, tmp_path):
    path, seen = str(tmp_path / "topic"), []
    write_topic_files(frames(spark, *BATCHES[0]), path)
    rows = change_rows(read_topic_files(spark, path, max_files_per_trigger=1), feed())
    start_preview(rows, n=1, emit=lambda df: seen.append(df.count()), trigger=NOW).awaitTermination()
    assert max(seen) == 1 and sum(seen) == 2  # one row per batch that has any
    static = change_rows(scan_topic_files(spark, path), feed())
    assert [r["id"] for r in preview_rows(static, 1, ["_offset"]).collect()] == [1]


def test_kafka_reader_settings():
    assert kafka_options("h:9092", "a.b.c") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a.b.c",
        "startingOffsets": "earliest",
        "kafkaConsumer.pollTimeoutMs": "120000",
    }
    options = kafka_options("h:9092", "t", "group", {"maxOffsetsPerTrigger": "1000"})
    assert options["kafka.group.id"] == "group" and options["maxOffsetsPerTrigger"] == "1000"


def test_csv_and_explicit_table(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("PRODUCT_ID,LIST_PRICE,op_type\n" + "163,3000,D\n" * 4 + "159,1994, R\n")
    ddl = "PRODUCT_ID STRING, LIST_PRICE STRING, op_type STRING"
    rows = scan_csv(spark, str(path), ddl)
    assert rows.count() == 5 and {r["op_type"] for r in rows.collect()} == {"D", " R"}
    name = f"t_{tmp_path.name.replace('-', '_')}"
    table = create_table(spark, name, ddl, str(tmp_path / "products"))
    rows.write.insertInto(table.sql_name)
    create_table(spark, name, ddl, str(tmp_path / "other"))  # exists already: kept
    assert query_table(spark, name).count() == 5


def test_default_trigger_keeps_running(spark, tmp_path):
    a_feed, path = feed(), str(tmp_path / "topic")
    write_topic_files(frames(spark, *BATCHES[0]), path)
    query = start_change_feed(
        spark, read_topic_files(spark, path), a_feed, str(tmp_path), f"{tmp_path}/cp"
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and query.lastProgress is None:
            time.sleep(0.5)
        assert len(versions(spark.table(quoted(scd2_name(a_feed.topic))))) == 2
        assert query.isActive
    finally:
        query.stop()


def history_of(spark, a_feed):
    return query_table(spark, a_feed.topic.split(".")[0] + ".items_hist")


def test_ledger_goes_by_checkpoint(spark, tmp_path):
    """A new checkpoint counts its batches from the start; none of them was applied before."""
    a_feed = feed(batch_ledger=True)
    path, root = str(tmp_path / "topic"), str(tmp_path)
    write_topic_files(frames(spark, *BATCHES[0][:1]), path)
    run(spark, path, a_feed, root, f"{root}/cp1")
    write_topic_files(frames(spark, *BATCHES[0][1:], start=10), path)
    run(spark, path, a_feed, root, f"{root}/cp2")
    assert len(versions(spark.table(quoted(scd2_name(a_feed.topic))))) == 2
    assert history_of(spark, a_feed).count() == 2
    with pytest.raises(ValueError, match="checkpoint"):
        run(spark, path, a_feed, root, None)


def test_ledger_covers_history_with_nulls(spark, tmp_path):
    a_feed = feed(batch_ledger=True)
    rows = change_rows(frames(spark, (1, None, "a", "c", 1), (2, "5", "a", "c", 1)), a_feed)
    made = prepare_tables(spark, rows, a_feed, str(tmp_path))
    for _ in range(2):
        apply_change_batch(spark, rows, a_feed, made, Delivery("q", 0))
    assert history_of(spark, a_feed).count() == 2
    apply_change_batch(spark, rows, a_feed, made, Delivery("other", 0))  # another checkpoint
    assert history_of(spark, a_feed).count() == 3


def test_history_of_a_lost_driver_is_not_doubled(spark, tmp_path, monkeypatch):
    a_feed = feed(batch_ledger=True)
    rows = change_rows(frames(spark, (1, None, "a", "c", 1), (2, "5", "a", "c", 1)), a_feed)
    made = prepare_tables(spark, rows, a_feed, str(tmp_path))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as lost:
        lost.setattr(history_step, "mark_applied", die)
        with pytest.raises(RuntimeError):
            apply_change_batch(spark, rows, a_feed, made, Delivery("q", 0))
    apply_change_batch(spark, rows, a_feed, made, Delivery("q", 0))
    assert history_of(spark, a_feed).count() == 2


def test_reader_in_another_session_sees_what_a_stream_appended(spark, tmp_path):
    a_feed = feed()
    path, root = str(tmp_path / "topic"), str(tmp_path)
    write_topic_files(frames(spark, *BATCHES[0][:1]), path)
    run(spark, path, a_feed, root, f"{root}/cp")
    assert history_of(spark, a_feed).count() == 1  # this session has listed the files now
    write_topic_files(frames(spark, *BATCHES[0][1:], start=10), path)
    run(spark, path, a_feed, root, f"{root}/cp")
    assert history_of(spark, a_feed).count() == 2
    rows = change_rows(scan_topic_files(spark, path), a_feed)
    made = prepare_tables(spark, rows, a_feed, root)
    history, _ = apply_change_batch(spark, rows, a_feed, made)
    assert history.inserted == 0 and history_of(spark, a_feed).count() == 2


@pytest.mark.parametrize("payload", [b"garbage", b'{"after": {"id": "x7", "price": "1", "name": "a"}, "op": "c"}'])
def test_malformed_payload_fails_the_batch(spark, tmp_path, payload):
    a_feed = feed()
    bad = spark.createDataFrame([(bytes(5) + payload, "t", 0, 0, None)], TOPIC)
    rows = change_rows(bad, a_feed)
    made = prepare_tables(spark, rows, a_feed, str(tmp_path))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        apply_change_batch(spark, rows, a_feed, made)
    assert history_of(spark, a_feed).count() == 0


def test_one_failed_feed_ends_the_wait(spark, tmp_path):
    good, bad = feed(), feed()
    root = str(tmp_path)
    write_topic_files(frames(spark, *BATCHES[0]), f"{root}/{good.topic}")
    write_topic_files(spark.createDataFrame([(bytes(5) + b"garbage", "t", 0, 0, None)], TOPIC), f"{root}/{bad.topic}")
    spark.streams.resetTerminated()
    queries = start_feeds(
        spark, [good, bad], lambda f: read_topic_files(spark, f"{root}/{f.topic}"), root, f"{root}/cp"
    )
    try:
        with pytest.raises(Exception, match="MALFORMED_RECORD|terminated with exception"):
            await_any(spark, timeout=120)
    finally:
        for query in queries:
            query.stop()
        spark.streams.resetTerminated()


def test_feeds_start_together_or_not_at_all(spark, tmp_path):
    good, bad = feed(), feed()
    root = str(tmp_path)
    write_topic_files(frames(spark, *BATCHES[0]), f"{root}/{good.topic}")

    def source(a_feed):
        if a_feed is bad:
            raise OSError("no such topic")
        return read_topic_files(spark, f"{root}/{a_feed.topic}")

    with pytest.raises(OSError):
        start_feeds(spark, [good, bad], source, root, f"{root}/cp")
    assert good.topic not in [q.name for q in spark.streams.active]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
