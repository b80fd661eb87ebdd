"""Many topics by one query over one source."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import AFTER, feed, versions
from tidemark.config import FlatFeed
from tidemark.functions.naming import quoted, scd2_name
from tidemark.plans.partitions import Delivery
from tidemark.sources.tables import query_table
from tidemark.sources.topics import kafka_options, read_topic_files, write_topic_files
from tidemark.streaming import feeds as single
from tidemark.streaming.shared import TopicsFailed, apply_topics, start_shared_feed

TOPIC = "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
NOW = {"availableNow": True}
DAY_MS = 86_400_000


def frames(spark, *messages):
    """(topic, key, price, name, op, day) or (topic, bytes) to topic rows."""
    made = []
    for offset, (topic, *rest) in enumerate(messages):
        if len(rest) == 1:
            body = rest[0]
        else:
            key, price, name, op, day = rest
            after = {"id": key, "price": price, "name": name}
            change = {"after": after, "op": op, "source": {"ts_ms": (19722 + day) * DAY_MS}, "ts_ms": 0}
            body = bytes(5) + json.dumps(change).encode()
        made.append((body, topic, 0, offset, None))
    return spark.createDataFrame(made, TOPIC)


def state(spark, a_feed):
    return versions(query_table(spark, scd2_name(a_feed.topic)))


def history(spark, a_feed):
    return query_table(spark, a_feed.topic.split(".")[0] + ".items_hist").count()


def run(spark, source, feeds, root, name, **more):
    query = start_shared_feed(spark, read_topic_files(spark, source), feeds, root, f"{root}/cp", NOW, name, **more)
    try:
        query.awaitTermination()
    finally:
        spark.streams.resetTerminated()
    return query


def test_each_topic_to_its_own_tables_from_one_read(spark, tmp_path):
    one, two = feed(batch_ledger=True), feed(batch_ledger=True, scd_cols=("name",))
    repeated = feed(topic=one.topic, scd_cols=("name",), batch_ledger=True)
    flat = FlatFeed(topic="flat." + one.topic.split(".")[0], record_ddl=AFTER)
    root, source, name = str(tmp_path), f"{tmp_path}/topics", one.topic
    record = bytes(5) + json.dumps({"id": 1, "price": "1", "name": "x"}).encode()
    messages = frames(
        spark,
        (one.topic, 1, "10", "a", "c", 1),
        (two.topic, 1, "7", "b", "c", 1),
        (flat.topic, record),
        (one.topic, 2, None, "a", "c", 1),
    )
    write_topic_files(messages, source)
    named = {flat.topic: "flat_" + one.topic.split(".")[0]}
    query = run(spark, source, [one, two, flat, repeated], root, name, flat_tables=named)
    assert query.name == name
    assert sum(p["numInputRows"] for p in query.recentProgress) == 4  # read once, not once per topic
    assert state(spark, one) == [("1", "10", "a", True, 1, None, "c"), ("2", None, "a", True, 1, None, "c")]
    assert state(spark, two) == [("1", "7", "b", True, 1, None, "c")]
    assert query_table(spark, named[flat.topic]).count() == 1

    write_topic_files(frames(spark, (one.topic, 1, "20", "a", "u", 2)), source)  # the others have no rows now
    run(spark, source, [one, two, flat], root, name, flat_tables=named)
    assert ("1", "20", "a", True, 2, None, "u") in state(spark, one) and len(state(spark, one)) == 3
    assert len(state(spark, two)) == 1


def test_a_topic_that_fails_leaves_the_others_applied_once(spark, tmp_path):
    good, bad = feed(batch_ledger=True), feed(batch_ledger=True)
    root, source, name = str(tmp_path), f"{tmp_path}/topics", good.topic
    messages = frames(
        spark,
        (bad.topic, 1, "1", "a", "c", 1),
        (bad.topic, bytes(5) + b"garbage"),
        (good.topic, 1, None, "a", "c", 1),
        (good.topic, 1, "2", "a", "u", 2),
    )
    write_topic_files(messages, source)
    for _ in range(2):  # the second time the batch is delivered again
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            run(spark, source, [good, bad], root, name)
        assert state(spark, good) == [("1", "2", "a", True, 2, None, "u")]
        assert history(spark, good) == 2 and history(spark, bad) == 0
    mended = feed(topic=bad.topic, batch_ledger=True, quarantine=True, carry=bad.carry)
    run(spark, source, [good, mended], root, name)
    assert history(spark, good) == 2 and history(spark, bad) == 1
    assert state(spark, bad) == [("1", "1", "a", True, 1, None, "c")]


def test_failures_are_told_by_topic(spark, tmp_path):
    feeds = {f.topic: f for f in (feed(batch_ledger=True), feed(batch_ledger=True), feed(batch_ledger=True))}
    first, second, third = feeds
    broken = bytes(5) + b"garbage"
    batch = frames(spark, (first, broken), (second, 1, "1", "a", "c", 1), (third, broken))
    made = {t: single.prepare_tables(spark, single.change_rows(batch, f), f, str(tmp_path)) for t, f in feeds.items()}
    with pytest.raises(TopicsFailed) as failure:
        apply_topics(spark, batch, feeds, made, Delivery("q", 0), at_once=1)
    assert set(failure.value.errors) == {first, third}
    assert history(spark, feeds[second]) == 1
    only = apply_topics(spark, batch.where(F.col("topic") == second), feeds, made, Delivery("q", 1))
    assert set(only) == {second} and only[second][0].inserted == 0


@pytest.mark.parametrize("topic", ["elsewhere", None])
def test_a_topic_without_a_feed_fails_the_batch(spark, tmp_path, topic):
    known = feed(batch_ledger=True)
    batch = frames(spark, (known.topic, 1, "1", "a", "c", 1), (topic, 1, "1", "a", "c", 1))
    made = single.prepare_tables(spark, single.change_rows(batch, known), known, str(tmp_path))
    with pytest.raises(ValueError, match=f"no feed for topic {topic}"):
        apply_topics(spark, batch, {known.topic: known}, {known.topic: made}, Delivery("q", 0))
    assert history(spark, known) == 0


def test_an_empty_batch(spark, tmp_path):
    known = feed(batch_ledger=True)
    batch = frames(spark, (known.topic, 1, "1", "a", "c", 1)).limit(0)
    made = single.prepare_tables(spark, single.change_rows(batch, known), known, str(tmp_path))
    assert apply_topics(spark, batch, {known.topic: known}, {known.topic: made}, Delivery("q", 0)) == {}


def test_what_sharing_a_source_needs(spark, tmp_path):
    source = read_topic_files(spark, str(tmp_path))
    with pytest.raises(ValueError, match="checkpoint"):
        start_shared_feed(spark, source, [feed(batch_ledger=True)], str(tmp_path), "")
    plain = feed()
    with pytest.raises(ValueError, match="batch_ledger"):
        start_shared_feed(spark, source, [plain], str(tmp_path), f"{tmp_path}/cp")
    assert not spark.catalog.tableExists(quoted(scd2_name(plain.topic)))


def test_one_subscription():
    assert kafka_options("h:9092", ["a", "b"])["subscribe"] == "a,b"
