"""Physical plans that matter at scale."""

import pytest

from helpers import feed, rows, tables
from tidemark.operators.merge import merge
from tidemark.operators.sizing import measure
from tidemark.operators.staging import match_versions, staged_updates
from tidemark.plans import history_step
from tidemark.plans.history_step import apply_history_batch
from tidemark.plans.scd2_step import apply_scd2_batch, newest_changes


def setup(spark, tmp_path):
    a_feed = feed()
    first = rows(spark, *[(i, "10", "a", "c", 1 + i % 5) for i in range(50)])
    made = tables(spark, first.drop("_offset"), a_feed, tmp_path)
    apply_scd2_batch(spark, first, made.scd2, a_feed)
    return a_feed, made, newest_changes(rows(spark, (1, "20", "a", "u", 9)), a_feed)


def test_measured_batch_is_broadcast_and_table_not_shuffled(spark, tmp_path, plan_of):
    a_feed, made, newest = setup(spark, tmp_path)
    text = plan_of(match_versions(spark.table(made.scd2.sql_name), newest, "left", small=True), "simple")
    assert "BroadcastHashJoin" in text and "BuildRight" in text
    scan = text[text.index("FileScan parquet") - 200 : text.index("FileScan parquet")]
    assert "Exchange" not in scan


@pytest.mark.parametrize("threshold", ["-1"])
def test_unmeasured_batch_joins_by_shuffle(spark, tmp_path, plan_of, threshold):
    a_feed, made, newest = setup(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        target = spark.table(made.scd2.sql_name)
        text = plan_of(merge(target, staged_updates(newest, target, ["price"]), ["price"], ["name"]), "simple")
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_is_measured(spark):
    df = rows(spark, (1, "10", "a", "c", 1), (2, None, "abcd", "c", 1))
    size = measure(df.select("price", "name"))
    assert size.rows == 2
    assert size.bytes == 2 * 8 * 3 + len("10") + len("a") + len("abcd")
    assert size.within(size.bytes) and not size.within(size.bytes - 1)
    assert measure(df.limit(0)).bytes == 0


def append(spark, a_feed, made, *changes, **settings):
    batch = rows(spark, *changes)
    apply_history_batch(spark, batch, made.history, a_feed.transport, a_feed.key_cols, **settings)


@pytest.mark.parametrize("settings", [{}, {"broadcast_bytes": 0}])
def test_history_comparison_reads_only_partitions_that_can_match(spark, tmp_path, monkeypatch, plan_of, settings):
    a_feed, made, _ = setup(spark, tmp_path)
    append(spark, a_feed, made, (1, "10", "a", "c", 1), (2, "10", "a", "c", 2))
    seen = []
    original = history_step.unseen_rows

    def watch(batch, history, *more):
        seen.append(plan_of(history))
        return original(batch, history, *more)

    monkeypatch.setattr(history_step, "unseen_rows", watch)
    append(spark, a_feed, made, (1, "10", "a", "c", 5), (1, "11", "a", "c", 5), **settings)
    assert "PartitionFilters: [isnotnull(ds" in seen[0] and "2024-01-01" in seen[0] and "2024-01-02" not in seen[0]
    got = sorted((r["id"], r["price"], r["ds"].day) for r in spark.table(made.history.sql_name).collect())
    assert got == [(1, "10", 1), (1, "11", 5), (2, "10", 2)]


@pytest.mark.parametrize("keys", [("row_id",), ("ID",)])
def test_history_with_bookkeeping_or_other_case_keys(spark, tmp_path, keys):
    a_feed, made, _ = setup(spark, tmp_path)
    for _ in range(2):
        batch = rows(spark, (1, "10", "a", "c", 1))
        apply_history_batch(spark, batch, made.history, a_feed.transport, keys)
    assert spark.table(made.history.sql_name).count() == 1
