"""One test per documented behaviour of the versioned table, and per opt-in rule."""

import pytest

from helpers import day, feed, rows, tables, versions
from tidemark.config import MergeRules
from tidemark.operators.merge import merge
from tidemark.operators.staging import staged_updates
from tidemark.plans.partitions import Delivery
from tidemark.plans.scd2_step import apply_scd2_batch, newest_changes, scd2_step
from tidemark.sources.tables import active_rows


def fold(spark, tmp_path, batches, **settings):
    """Apply batches to a table; with opt-in rules the storage-free step must agree.

    (For the default rules the random batches compare the two.)
    """
    a_feed = feed(**settings)
    twice = a_feed.rules != MergeRules()
    frames = [rows(spark, *b) for b in batches]
    table = tables(spark, frames[0].drop("_offset"), a_feed, tmp_path).scd2
    plain = spark.createDataFrame([], spark.table(table.sql_name).schema)
    for i, frame in enumerate(frames):
        apply_scd2_batch(spark, frame, table, a_feed, i)
        if twice:
            plain = scd2_step(plain, frame, a_feed).checkpoint()
    got = versions(spark.table(table.sql_name))
    if twice:
        assert versions(plain) == got
    return got


def test_change_closes_and_reinserts(spark, tmp_path):
    assert fold(spark, tmp_path, [[(1, "10", "a", "c", 1)], [(1, "20", "b", "u", 2)]]) == [
        ("1", "10", "a", False, 1, 2, "u"),
        ("1", "20", "b", True, 2, None, "u"),
    ]


def test_overwrite_in_place_reaches_closed_versions(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1)], [(1, "20", "a", "u", 2)], [(1, "20", "z", "u", 3)]]
    assert fold(spark, tmp_path, batches) == [
        ("1", "10", "z", False, 1, 2, "u"),
        ("1", "20", "z", True, 2, None, "u"),
    ]
    rules = MergeRules(active_only_overwrite=True)
    assert fold(spark, tmp_path / "b", batches, rules=rules)[0] == ("1", "10", "a", False, 1, 2, "u")


def test_only_newest_row_of_a_batch_counts(spark, tmp_path):
    assert fold(spark, tmp_path, [[(1, "10", "a", "c", 1), (1, "20", "a", "u", 2), (1, "30", "a", "u", 3)]]) == [
        ("1", "30", "a", True, 3, None, "u")
    ]


def test_null_changes_are_invisible_by_default(spark, tmp_path):
    batches = [[(1, None, "a", "c", 1), (2, "5", "a", "c", 1)], [(1, "9", "a", "u", 2), (2, None, "a", "u", 2)]]
    assert fold(spark, tmp_path, batches) == [
        ("1", None, "a", True, 1, None, "c"),
        ("2", "5", "a", True, 1, None, "c"),
    ]
    assert len(fold(spark, tmp_path / "b", batches, rules=MergeRules(null_safe=True))) == 4


def test_delete_with_changed_column_reinserts_by_default(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1)], [(1, "20", "a", "d", 2)]]
    assert fold(spark, tmp_path, batches) == [
        ("1", "10", "a", False, 1, 2, "d"),
        ("1", "20", "a", True, 2, None, "d"),
    ]
    assert fold(spark, tmp_path / "b", batches, rules=MergeRules(honor_deletes=True)) == [
        ("1", "10", "a", False, 1, 2, "d")
    ]


def test_plain_delete_closes(spark, tmp_path):
    assert fold(spark, tmp_path, [[(1, "10", "a", "c", 1)], [(1, "10", "a", "d", 2)]]) == [
        ("1", "10", "a", False, 1, 2, "d")
    ]


def test_only_lower_case_code_deletes(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1)], [(1, "10", "a", "D", 2)], [(1, "10", "a", " d", 3)]]
    assert fold(spark, tmp_path, batches) == [("1", "10", "a", True, 1, None, "c")]


def test_delete_of_unknown_key_inserts_by_default(spark, tmp_path):
    batch = [[(1, "10", "a", "d", 1)]]
    assert fold(spark, tmp_path, batch) == [("1", "10", "a", True, 1, None, "d")]
    assert fold(spark, tmp_path / "b", batch, rules=MergeRules(honor_deletes=True)) == []


def test_closed_key_stays_closed_unless_reopened(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1)], [(1, "10", "a", "d", 2)], [(1, "30", "a", "c", 3)]]
    closed = ("1", "10", "a", False, 1, 2, "d")
    assert fold(spark, tmp_path, batches) == [closed]
    assert fold(spark, tmp_path / "b", batches, rules=MergeRules(reopen=True)) == [
        closed,
        ("1", "30", "a", True, 3, None, "c"),
    ]


def test_empty_key_is_a_key_of_its_own(spark, tmp_path):
    """A delete without an image has an empty key and leaves the real key alone."""
    batches = [[(1, "10", "a", "c", 1)], [(None, None, None, "d", 2)]]
    assert fold(spark, tmp_path, batches) == [
        ("", None, None, True, 2, None, "d"),
        ("1", "10", "a", True, 1, None, "c"),
    ]


def test_replayed_batch_closes_reinserted_delete(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1)], [(1, "20", "a", "d", 2)], [(1, "20", "a", "d", 2)]]
    assert fold(spark, tmp_path, batches)[-1] == ("1", "20", "a", False, 2, 2, "d")


def test_ledger_skips_an_applied_batch(spark, tmp_path):
    a_feed = feed(batch_ledger=True)
    first, second = rows(spark, (1, "10", "a", "c", 1)), rows(spark, (1, "20", "a", "d", 2))
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    apply_scd2_batch(spark, first, table, a_feed, Delivery("q", 0))
    apply_scd2_batch(spark, second, table, a_feed, Delivery("q", 1))
    before = versions(spark.table(table.sql_name))
    assert apply_scd2_batch(spark, second, table, a_feed, Delivery("q", 1)).skipped
    assert versions(spark.table(table.sql_name)) == before


def test_late_row_is_applied_as_new(spark, tmp_path):
    assert fold(spark, tmp_path, [[(1, "10", "a", "c", 9)], [(1, "20", "a", "u", 2)]]) == [
        ("1", "10", "a", False, 9, 2, "u"),
        ("1", "20", "a", True, 2, None, "u"),
    ]


def test_missing_date_goes_to_the_null_partition(spark, tmp_path):
    batches = [[(1, "10", "a", "c", None)], [(1, "20", "a", "u", None)], [(1, "30", "a", "u", 3)]]
    assert fold(spark, tmp_path, batches) == [
        ("1", "10", "a", False, None, None, "u"),
        ("1", "20", "a", False, None, 3, "u"),
        ("1", "30", "a", True, 3, None, "u"),
    ]


def test_variants_follow_the_column_lists(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1), (2, "10", "a", "c", 1)], [(1, "20", "b", "u", 2), (2, "10", "b", "d", 2)]]
    both_versioned = fold(spark, tmp_path, batches, scd_cols=("price", "name"))
    assert len(both_versioned) == 4
    none_versioned = fold(spark, tmp_path / "b", batches, scd_cols=())
    assert none_versioned == [
        ("1", "20", "b", True, 1, None, "c"),
        ("2", "10", "a", False, 1, 2, "d"),
    ]


def test_no_columns_to_maintain_does_nothing(spark, tmp_path):
    assert fold(spark, tmp_path, [[(1, "10", "a", "c", 1)]], key_cols=("id", "price", "name"), scd_cols=()) == []


def test_merge_operators_directly(spark, tmp_path):
    a_feed = feed()
    first, second = rows(spark, (1, "10", "a", "c", 1)), rows(spark, (1, "20", "b", "u", 2), (3, "1", "c", "c", 2))
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    apply_scd2_batch(spark, first, table, a_feed)
    target, newest = spark.table(table.sql_name), newest_changes(second, a_feed)
    staged = staged_updates(newest, target, ["price"])
    keys = sorted((r["mergeKey"], r["JoinKey"]) for r in staged.where("mergeKey is not null").collect())
    assert keys == [("1", "1"), ("3", "3")]
    assert [r["JoinKey"] for r in staged.where("mergeKey is null").collect()] == ["1"]
    assert len(versions(merge(target, staged, ["price"], ["name"]))) == 3
    assert len(versions(merge(target, staged, ["price"], ()))) == 3
    plain = staged_updates(newest, target, [])
    assert versions(merge(target, plain, (), ["price", "name"])) == [
        ("1", "20", "b", True, 1, None, "c"),
        ("3", "1", "c", True, 2, None, "c"),
    ]


def test_active_view_and_pruned_read(spark, tmp_path, plan_of):
    a_feed = feed()
    first, second = rows(spark, (1, "10", "a", "c", 1), (2, "1", "a", "c", 2)), rows(spark, (1, "20", "a", "u", 2))
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    apply_scd2_batch(spark, first, table, a_feed)
    apply_scd2_batch(spark, second, table, a_feed)
    assert [v[:2] for v in versions(active_rows(spark, table.name))] == [("1", "20"), ("2", "1")]
    text = plan_of(active_rows(spark, table.name).where(f"EffectiveDate = date'{day(1)}'").select("JoinKey"))
    assert "PartitionFilters: [isnotnull(EffectiveDate" in text
    assert "EqualTo(ActiveIndicator,true)" in text
    assert "ReadSchema: struct<JoinKey:string,ActiveIndicator:boolean>" in text


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_report_counts(spark, tmp_path, limit):
    a_feed = feed(broadcast_bytes=limit)
    first = rows(spark, (1, "10", "a", "c", 1), (2, "10", "a", "c", 1), (3, "10", "a", "c", 2))
    table = tables(spark, first.drop("_offset"), a_feed, tmp_path).scd2
    one = apply_scd2_batch(spark, first, table, a_feed)
    assert (one.keys, one.inserted, one.closed, one.overwritten, one.partitions) == (3, 3, 0, 0, 2)
    two = apply_scd2_batch(
        spark, rows(spark, (1, "20", "a", "u", 5), (3, "10", "b", "u", 5), (9, "1", "a", "c", 5)), table, a_feed
    )
    assert (two.keys, two.inserted, two.closed, two.overwritten, two.partitions) == (3, 2, 1, 1, 3)
