"""Active and closed versions in files of their own."""

import pytest
from pyspark.sql import functions as F

from helpers import day, feed, rows, tables, versions
from tidemark.config import TIMELINE, MergeRules
from tidemark.plans.scd2_step import apply_scd2_batch
from tidemark.sources.tables import active_rows, open_table
from tidemark.streaming.feeds import start_change_feed

STEPS = (
    [(k, "1", "a", "c", 1) for k in range(20)],
    [(k, "2", "a", "u", 2) for k in range(0, 20, 2)] + [(1, "1", "b", "u", 2)],
    [(k, "2", "b", "d", 3) for k in range(0, 20, 4)] + [(30, None, None, "c", 1)],
    [(2, "9", "z", "u", 4), (5, "9", "z", "u", 4), (30, "8", None, "u", 4)],
)


def applied(spark, tmp_path, **settings):
    a_feed = feed(order_cols=("_offset",), **settings)
    made, reports = None, []
    for step in STEPS:
        batch = rows(spark, *step)
        made = made or tables(spark, batch, a_feed, tmp_path)
        reports.append(apply_scd2_batch(spark, batch, made.scd2, a_feed))
    return made.scd2, reports


def kinds(spark, table):
    """(first name of a file, does it hold active rows, does it hold closed rows)."""
    found = spark.table(table.sql_name).groupBy("_metadata.file_path", "_metadata.file_name").agg(
        F.expr("bool_or(ActiveIndicator)").alias("open"), F.expr("bool_or(NOT ActiveIndicator)").alias("closed")
    )
    return {(r["file_name"].split("-")[0], r["open"], r["closed"]) for r in found.collect()}


@pytest.mark.parametrize("settings", [
    {},
    {"broadcast_bytes": 0, "hot_versions": 2},
    {"key_buckets": 3},
    {"rules": MergeRules(null_safe=True, honor_deletes=True, reopen=True, active_only_overwrite=True)},
    {"rules": TIMELINE},
], ids=["small", "shuffled", "buckets", "opt-in", "timeline"])
def test_split_or_not_the_table_is_the_same(spark, tmp_path, settings):
    plain, reports = applied(spark, tmp_path / "plain", **settings)
    split, others = applied(spark, tmp_path / "split", split_active=True, **settings)
    assert versions(spark.table(split.sql_name)) == versions(spark.table(plain.sql_name))
    assert reports == others
    assert kinds(spark, split) == {("open", True, False), ("closed", False, True)}
    assert {name for name, *_ in kinds(spark, plain)} == {"part"}
    assert versions(active_rows(spark, split.name)) == versions(active_rows(spark, plain.name))


def test_files_of_closed_versions_are_not_opened(spark, tmp_path):
    table, _ = applied(spark, tmp_path, split_active=True)
    expected = versions(active_rows(spark, table.name))
    closed = [p for p in tmp_path.rglob("closed-*.parquet")]
    assert closed and len(expected) > 10
    for path in closed:
        path.write_bytes(b"not parquet")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert versions(active_rows(spark, table.name)) == expected
    with pytest.raises(Exception, match="FAILED_READ_FILE|not a Parquet file"):
        spark.table(table.sql_name).where("ActiveIndicator = true").select("name").collect()


def test_files_from_before_are_read_and_sorted_out(spark, tmp_path):
    """Rows that somebody added in files of other names are neither lost nor left where they are."""
    table, _ = applied(spark, tmp_path, split_active=True)
    whole = spark.table(table.sql_name)
    added = whole.limit(1).withColumn("JoinKey", F.lit("77")).withColumn("ActiveIndicator", F.lit(True))
    added = added.withColumn(table.partition_col, F.lit(day(4))).select(*whole.columns)
    added.write.insertInto(table.sql_name)
    assert "77" in [r["JoinKey"] for r in active_rows(spark, table.name).collect()]
    a_feed = feed(split_active=True)
    apply_scd2_batch(spark, rows(spark, (5, "10", "z", "u", 5)), table, a_feed)
    assert [r["JoinKey"] for r in active_rows(spark, table.name).collect()].count("77") == 1
    assert ("part", True, False) not in kinds(spark, table)


def test_an_opened_table_knows_its_layout(spark, tmp_path):
    split, _ = applied(spark, tmp_path / "split", split_active=True, key_buckets=2)
    again = open_table(spark, split.name)
    assert again.split_active and again.key_buckets == 2
    plain, _ = applied(spark, tmp_path / "plain")
    assert not open_table(spark, plain.name).split_active


def test_not_for_formats_with_a_merge_of_their_own(spark, tmp_path):
    with pytest.raises(ValueError, match="split_active"):
        start_change_feed(spark, None, feed(split_active=True, table_format="delta"), str(tmp_path), f"{tmp_path}/cp")
