"""Which files a merge touches, and what happens when a driver dies half way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import feed, rows, tables, versions
from tidemark.functions.keys import with_business_key
from tidemark.plans import partitions as moves
from tidemark.plans.merge_into import merge_into
from tidemark.plans.partitions import Delivery, remove_stale_versions
from tidemark.plans.scd2_step import apply_scd2_batch, newest_changes
from tidemark.operators.staging import point_filter, stage
from tidemark.sources.tables import open_table


def two_batches(spark, tmp_path, **settings):
    a_feed = feed(**settings)
    first = rows(spark, (1, "10", "a", "c", 1), (2, "10", "a", "c", 2), (3, "10", "a", "c", 3))
    second = rows(spark, (2, "20", "a", "u", 9))
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    apply_scd2_batch(spark, first, table, a_feed, Delivery("q", 0))
    return a_feed, table, second


def files_by_day(spark, table):
    out = {}
    for name in spark.table(table.sql_name).inputFiles():
        out.setdefault(name.split("EffectiveDate=")[1].split("/")[0], set()).add(name)
    return out


def test_only_partitions_with_a_change_are_rewritten(spark, tmp_path):
    a_feed, table, second = two_batches(spark, tmp_path)
    before = files_by_day(spark, table)
    report = apply_scd2_batch(spark, second, table, a_feed)
    assert (report.inserted, report.closed, report.rewritten) == (1, 1, 2)
    after = files_by_day(spark, table)
    assert before["2024-01-01"] == after["2024-01-01"]
    assert before["2024-01-03"] == after["2024-01-03"]
    assert before["2024-01-02"] != after["2024-01-02"]
    assert set(after) == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09"}


def test_unchanged_batch_writes_nothing(spark, tmp_path):
    a_feed, table, _ = two_batches(spark, tmp_path)
    before = files_by_day(spark, table)
    report = apply_scd2_batch(spark, rows(spark, (2, "10", "a", "u", 9)), table, a_feed)
    assert report.partitions == 0 and files_by_day(spark, table) == before


@pytest.mark.parametrize("lost_after", [0, 1])
def test_interrupted_move_is_finished_by_the_next_batch(spark, tmp_path, monkeypatch, lost_after):
    a_feed, table, second = two_batches(spark, tmp_path, batch_ledger=True)
    original = moves._move

    def die(session, ref, folder, listed, delivery):
        if lost_after:  # some partitions already moved
            original(session, ref, folder, listed[:lost_after], None)
            moves.set_properties(session, ref, **{moves.PENDING: f"{delivery.text}|{folder}"})
        raise RuntimeError("driver lost")

    monkeypatch.setattr(moves, "_move", die)
    with pytest.raises(RuntimeError):
        apply_scd2_batch(spark, second, table, a_feed, Delivery("q", 1))
    monkeypatch.setattr(moves, "_move", original)

    again = apply_scd2_batch(spark, second, open_table(spark, table.name), a_feed, Delivery("q", 1))
    assert again.skipped
    assert versions(spark.table(table.sql_name)) == [
        ("1", "10", "a", True, 1, None, "c"),
        ("2", "10", "a", False, 2, 9, "u"),
        ("2", "20", "a", True, 9, None, "u"),
        ("3", "10", "a", True, 3, None, "c"),
    ]


def test_row_that_moves_leaves_no_stale_partition(spark, tmp_path):
    """The partition date is overwritten in place, so a row can leave its partition empty."""
    a_feed = feed(after_ddl="id BIGINT, price STRING, day INT", partition_col="day")

    def batch(*tuples):
        df = spark.createDataFrame(
            [(k, p, d, "u", dt.date(2024, 1, 1), i) for i, (k, p, d) in enumerate(tuples)],
            "id BIGINT, price STRING, day INT, op_type STRING, ds DATE, _offset BIGINT",
        ).withColumn("day_PARTITION", F.date_from_unix_date("day"))
        return with_business_key(df, ["id"])

    first = batch((1, "10", 5), (2, "10", 6), (4, "10", 6))
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    apply_scd2_batch(spark, first, table, a_feed)
    apply_scd2_batch(spark, batch((1, "10", 6), (2, "10", None)), table, a_feed)
    # a null is no change by default, so key 2 stays where it is
    assert sorted(tuple(r) for r in spark.table(table.sql_name).select("JoinKey", "day").collect()) == [
        ("1", 6), ("2", 6), ("4", 6),
    ]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table.sql_name}").collect()] == [
        "day_PARTITION=1970-01-07"
    ]


def test_moved_row_survives_without_partition_type_inference(spark, tmp_path):
    a_feed = feed(after_ddl="id BIGINT, price STRING, day INT", partition_col="day")

    def batch(day):
        df = spark.createDataFrame(
            [(k, "10", day, "u", dt.date(2024, 1, 1), k) for k in (1, 2)],
            "id BIGINT, price STRING, day INT, op_type STRING, ds DATE, _offset BIGINT",
        ).withColumn("day_PARTITION", F.date_from_unix_date("day"))
        return with_business_key(df, ["id"])

    table = tables(spark, batch(5).drop("_offset"), a_feed, tmp_path).scd2
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(name, "false")
    try:
        apply_scd2_batch(spark, batch(5), table, a_feed)
        apply_scd2_batch(spark, batch(6), table, a_feed)
        assert sorted(tuple(r) for r in spark.table(table.sql_name).select("id", "day").collect()) == [(1, 6), (2, 6)]
    finally:
        spark.conf.unset(name)


def test_key_buckets_narrow_what_is_rewritten(spark, tmp_path):
    first = rows(spark, *[(k, "10", "a", "c", 1 + k % 2) for k in range(40)])
    second = rows(spark, (7, "20", "a", "u", 9))
    seen = {}
    for buckets in (0, 8):
        a_feed = feed(key_buckets=buckets)
        table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
        apply_scd2_batch(spark, first, table, a_feed)
        opened = open_table(spark, table.name)
        assert opened.key_buckets == buckets
        report = apply_scd2_batch(spark, second, opened, a_feed)
        seen[buckets] = (report.rewritten, versions(spark.table(table.sql_name)))
        assert (report.inserted, report.closed) == (1, 1)
        assert remove_stale_versions(spark, opened, dry_run=False) == []  # one folder of each batch is live
    assert seen[0][1] == seen[8][1] and seen[8][0] < seen[0][0] == 21


def test_stale_folders_are_listed_and_live_ones_stay(spark, tmp_path):
    a_feed, table, second = two_batches(spark, tmp_path)
    apply_scd2_batch(spark, second, table, a_feed)
    apply_scd2_batch(spark, rows(spark, (2, "30", "a", "u", 10), (1, "11", "a", "u", 10), (3, "9", "a", "u", 10)), table, a_feed)
    before = versions(spark.table(table.sql_name))
    stale = remove_stale_versions(spark, table)
    assert stale and remove_stale_versions(spark, table) == stale  # a dry run changes nothing
    assert remove_stale_versions(spark, table, dry_run=False) == stale
    spark.catalog.refreshTable(table.sql_name)
    assert versions(spark.table(table.sql_name)) == before
    assert remove_stale_versions(spark, table) == []


def test_open_table_reads_the_catalog(spark, tmp_path):
    _, table, _ = two_batches(spark, tmp_path)
    opened = open_table(spark, table.name)
    assert (opened.partition_col, opened.format) == ("EffectiveDate", "parquet")
    assert opened.location.endswith(table.location)


def test_formats_with_their_own_merge_get_all_clauses(spark, tmp_path):
    """Parquet refuses MERGE, so this shows only that the statement resolves that far."""
    a_feed, table, second = two_batches(spark, tmp_path)
    staged = stage(newest_changes(second, a_feed), None)
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_into(staged, table, ["price"], ["name"], a_feed.rules)


def scanned(df):
    """Rows that the scan below ``df`` read."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_row_groups_without_the_keys_are_not_read(spark, tmp_path, plan_of):
    """Keys in the range of every file, but in few: only the Bloom filters can tell."""
    a_feed = feed()
    first = rows(spark, *[(k, "10", "a", "c", 1 + k % 10) for k in range(2000)])
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    apply_scd2_batch(spark, first, table, a_feed)
    wanted = point_filter(newest_changes(rows(spark, (777, "20", "a", "u", 12), (1007, "20", "a", "u", 12)), a_feed), 2)
    found = spark.table(table.sql_name).where(wanted).select("JoinKey", "EffectiveDate")
    text = plan_of(found)
    assert "PushedFilters" in text and "EqualTo(JoinKey,777)" in text
    assert found.count() == 2 and scanned(found) < 600  # one or two of ten days of 200 rows
    assert point_filter(newest_changes(first, a_feed), 2000) is None


def test_keys_with_quotes_are_found(spark, tmp_path):
    a_feed = feed(after_ddl="id STRING, price STRING, name STRING")
    odd = ["it's", 'a "b"', "c\\d", "e\\'f", "", "100%"]

    def batch(price, day):
        made = [(k, price, "n", "u", dt.date(2024, 1, day), i) for i, k in enumerate(odd)]
        return with_business_key(spark.createDataFrame(made, "id STRING, price STRING, name STRING, op_type STRING, ds DATE, _offset BIGINT"), ["id"])

    table = tables(spark, batch("1", 1).drop("_offset"), a_feed, tmp_path).scd2
    for price, day in (("1", 1), ("2", 2)):
        report = apply_scd2_batch(spark, batch(price, day), table, a_feed)
    assert (report.inserted, report.closed) == (len(odd), len(odd))


def test_moves_take_as_many_catalog_calls_for_many_partitions(spark, tmp_path, monkeypatch):
    calls = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (calls.append(text), plain(self, text, *a, **b))[1])
    seen = []
    for n in (3, 24):
        a_feed = feed(key_buckets=2)
        first = rows(spark, *[(k, "10", "a", "c", 1 + k % n) for k in range(60)])
        table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
        apply_scd2_batch(spark, first, table, a_feed)
        calls.clear()
        report = apply_scd2_batch(spark, rows(spark, *[(k, "20", "b", "u", 1 + k % n) for k in range(60)]), table, a_feed)
        assert report.partitions >= n and report.closed == 60
        seen.append(len(calls))
    assert seen[0] == seen[1]
