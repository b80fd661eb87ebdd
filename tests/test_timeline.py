"""Every change of a batch as a version, and changes placed by time, against a batch per change."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import feed, rows, tables, versions
from tidemark.config import TIMELINE, MergeRules
from tidemark.operators import timeline
from tidemark.plans.scd2_step import apply_scd2_batch, scd2_step

ONE_BY_ONE = MergeRules(null_safe=True, honor_deletes=True, reopen=True)


def draw(rng, n, keys=(2, 3, 4, 5, None)):
    out = []
    for i in range(n):
        key = 1 if rng.random() < 0.33 else rng.choice(keys)  # key 1 holds about a third of all rows
        out.append((key, rng.choice(["10", "20", None]), rng.choice(["a", "b", None]), rng.choice("cuuud"), rng.choice([1, 2, 3, None]), i))
    return out


def plain(changes, active_only=False):
    """The table after a batch per change, in plain Python."""
    table = []
    for key, price, name, op, day, _ in sorted(changes, key=lambda c: (c[4] is not None, c[4] or 0, c[5])):
        key = "" if key is None else str(key)
        own = [v for v in table if v[0] == key]
        active = [v for v in own if v[3]]
        closed_now = None
        if active and (op == "d" or active[0][1] != price):
            closed_now = active[0]
            closed_now[3], closed_now[5], closed_now[6] = False, day, op
        for v in own:
            if v is not closed_now and (v[3] or not active_only):
                v[2] = name
        if op != "d" and (not active or closed_now):
            table.append([key, price, name, True, day, None, op])
    return sorted((tuple(v) for v in table), key=repr)


def apply_all(spark, tmp_path, batches, **settings):
    a_feed = feed(**settings)
    first = rows(spark, *batches[0])
    made = tables(spark, first if a_feed.rules.by_time else first.drop("_offset"), a_feed, tmp_path)
    for batch in batches:
        apply_scd2_batch(spark, rows(spark, *batch), made.scd2, a_feed, changes_table=made.changes)
    return versions(spark.table(made.scd2.sql_name))


def test_rules_that_do_not_go_together():
    with pytest.raises(ValueError):
        MergeRules(every_change=True)
    with pytest.raises(ValueError):
        MergeRules(null_safe=True, honor_deletes=True, reopen=True, by_time=True)


def test_a_run_is_one_version(spark):
    a_feed = feed(rules=TIMELINE)
    batch = rows(spark, (1, "10", "a", "c", 1), (1, "10", "b", "u", 2), (1, "20", "c", "u", 3), (1, "20", "d", "d", 4), (1, "20", "e", "u", 5))
    empty = spark.createDataFrame([], "JoinKey STRING, id BIGINT, price STRING, name STRING, ActiveIndicator BOOLEAN, EffectiveDate DATE, EndDate DATE, Action STRING")
    assert versions(scd2_step(empty, batch, a_feed)) == [
        ("1", "10", "e", False, 1, 3, "u"),
        ("1", "20", "e", False, 3, 4, "d"),
        ("1", "20", "e", True, 5, None, "u"),
    ]


@pytest.mark.parametrize("active_only", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_batch_equals_a_batch_per_change(spark, seed, active_only):
    """Against the merge itself, step by step, and against plain Python."""
    rng = random.Random(seed)
    changes = draw(rng, 24 if seed == 1 else 80)
    a_feed = feed(rules=replace(TIMELINE, active_only_overwrite=active_only))
    single = replace(a_feed, rules=replace(ONE_BY_ONE, active_only_overwrite=active_only))
    target = spark.createDataFrame([], "JoinKey STRING, id BIGINT, price STRING, name STRING, ActiveIndicator BOOLEAN, EffectiveDate DATE, EndDate DATE, Action STRING")
    whole = versions(scd2_step(target, rows(spark, *changes), a_feed))
    assert whole == plain(changes, active_only)
    if seed == 1 and not active_only:
        batch = rows(spark, *changes)
        place = F.row_number().over(Window.partitionBy("JoinKey").orderBy(F.asc_nulls_first("ds"), "_offset"))
        ranked = batch.withColumn("n", place).cache()
        for n in range(1, ranked.agg(F.max("n")).first()[0] + 1):
            target = scd2_step(target, ranked.where(F.col("n") == n).drop("n"), single).checkpoint()
        assert versions(target) == whole


@pytest.mark.parametrize("settings", [{}, {"broadcast_bytes": 0, "hot_versions": 2}, {"key_buckets": 3}])
def test_batches_in_order_equal_one(spark, tmp_path, settings):
    """However the changes are cut into batches; with few changes per day and key, sorted day by day."""
    rng = random.Random(7)
    changes = sorted(draw(rng, 60), key=lambda c: (c[4] is not None, c[4] or 0, c[5]))
    cut = [changes[:20], changes[20:21], changes[21:]]
    assert apply_all(spark, tmp_path, cut, rules=TIMELINE, **settings) == plain(changes)


def test_neighbours_day_by_day_equal_plain_ones(spark):
    rng = random.Random(3)
    batch = rows(spark, *draw(rng, 200, keys=(2, 3)))
    order = [F.asc_nulls_first("ds"), F.col("_offset")]
    for step in (-1, 1):
        both = [sorted(map(repr, timeline.beside(batch, order, "_offset", "next", step, by_day).collect())) for by_day in (False, True)]
        assert both[0] == both[1]


BY_TIME = replace(TIMELINE, by_time=True)


@pytest.mark.parametrize("seed, settings", [(1, {}), (2, {"broadcast_bytes": 0, "hot_versions": 2}), (3, {"key_buckets": 2})])
def test_any_order_of_arrival_gives_the_same_table(spark, tmp_path, seed, settings):
    rng = random.Random(seed)
    changes = draw(rng, 36)
    wanted = plain(changes)
    rng.shuffle(changes)
    cut = [changes[:14], changes[14:15], changes[15:]]
    assert apply_all(spark, tmp_path, cut, rules=BY_TIME, **settings) == wanted


def test_a_late_change_splits_the_version_that_covers_it(spark, tmp_path):
    batches = [[(1, "10", "a", "c", 1, 0), (1, "10", "b", "u", 9, 1)], [(1, "20", "c", "u", 5, 2)]]
    assert apply_all(spark, tmp_path, batches, rules=BY_TIME) == [
        ("1", "10", "b", False, 1, 5, "u"),
        ("1", "10", "b", True, 9, None, "u"),
        ("1", "20", "c", False, 5, 9, "u"),  # closed by the last change, which does not overwrite it
    ]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    batch = [(1, "10", "a", "c", 1, 0), (1, "20", "b", "u", 9, 1), (2, "10", "b", "d", 3, 2)]
    later = [(1, "30", "c", "u", 5, 3)]
    assert apply_all(spark, tmp_path, [batch, later, later, batch], rules=BY_TIME) == plain(batch + later)


def test_a_table_of_changes_needs_its_order(spark, tmp_path):
    with pytest.raises(ValueError, match="_offset"):
        tables(spark, rows(spark, (1, "10", "a", "c", 1)).drop("_offset"), feed(rules=BY_TIME), tmp_path)
