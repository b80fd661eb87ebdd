import pytest

from helpers import feed, rows, tables
from tidemark.config import MergeRules
from tidemark.functions.keys import history_columns
from tidemark.operators.history import unseen_rows
from tidemark.operators.sizing import measure
from tidemark.plans import history_step
from tidemark.plans.history_step import apply_history_batch
from tidemark.plans.partitions import Delivery

COMPARE = ["id", "price", "name", "op_type"]


def stored(spark, table):
    return sorted(
        ((r["id"], r["price"], r["name"], r["op_type"], r["ds"] and r["ds"].day) for r in spark.table(table.sql_name).collect()),
        key=repr,
    )


def run(spark, tmp_path, batches, **settings):
    a_feed = feed(**settings)
    first = rows(spark, *batches[0])
    hist = tables(spark, first.drop("_offset"), a_feed, tmp_path).history
    for batch in batches:
        apply_history_batch(
            spark, rows(spark, *batch), hist, a_feed.transport, a_feed.key_cols, a_feed.rules, a_feed.broadcast_bytes
        )
    return stored(spark, hist)


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_insert_if_absent(spark, tmp_path, limit):
    got = run(
        spark,
        tmp_path,
        [
            [(1, "10", "a", "c", 1), (1, "10", "a", "c", 1), (2, "5", None, "c", 1)],
            # same values on another day: known; null rows never match; new operation code: new
            [(1, "10", "a", "c", 9), (2, "5", None, "c", 9), (1, "10", "a", "u", 9), (1, "10", "a", "u", 9)],
        ],
        broadcast_bytes=limit,
    )
    assert got == [
        (1, "10", "a", "c", 1),
        (1, "10", "a", "c", 1),  # duplicates inside one batch all stay
        (1, "10", "a", "u", 9),
        (1, "10", "a", "u", 9),
        (2, "5", None, "c", 1),
        (2, "5", None, "c", 9),
    ]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_null_safe_replay_adds_nothing(spark, tmp_path, limit):
    # the row without a key is alone in its partition
    batch = [(1, None, "a", "c", 1), (2, "5", None, None, None), (None, None, None, "d", 7)]
    got = run(spark, tmp_path, [batch, batch], rules=MergeRules(null_safe=True), broadcast_bytes=limit)
    assert len(got) == 3


def test_value_that_returns_is_swallowed(spark, tmp_path):
    got = run(spark, tmp_path, [[(1, "10", "a", "u", 1)], [(1, "20", "a", "u", 2)], [(1, "10", "a", "u", 3)]])
    assert [r[1] for r in got] == ["10", "20"]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("null_safe", [True, False])
def test_both_join_paths_agree_with_brute_force(spark, small, null_safe):
    import random

    rng = random.Random(7)

    def draw(n):
        return [
            (rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None]), rng.choice("xy"), rng.choice("cu"), rng.randint(1, 3))
            for _ in range(n)
        ]

    old, new = draw(25), draw(200)
    # a third of the batch is one value
    new += [(1, "a", "x", "c", 1)] * 100
    hist, batch = rows(spark, *old).drop("JoinKey"), rows(spark, *new).drop("JoinKey")

    def known(row):
        return any(
            all((a == b and (null_safe or a is not None)) for a, b in zip(row[:4], h[:4])) for h in old
        )

    expected = sorted((r[:4] for r in new if not known(r)), key=repr)
    got = unseen_rows(batch, hist, COMPARE, null_safe, small, cut=lambda df: df.checkpoint())
    assert sorted((tuple(r) for r in got.select(*COMPARE).collect()), key=repr) == expected


def test_small_batch_does_not_shuffle_history(spark, tmp_path, plan_of):
    a_feed = feed()
    first = rows(spark, (1, "10", "a", "c", 1))
    hist = tables(spark, first.drop("_offset"), a_feed, tmp_path).history
    for inserted in (1, 0):
        report = apply_history_batch(spark, first, hist, a_feed.transport, a_feed.key_cols)
        assert (report.batch_rows, report.inserted) == (1, inserted)
    batch = rows(spark, (1, "10", "a", "c", 2)).drop("JoinKey", "_offset")
    text = plan_of(unseen_rows(batch, spark.table(hist.sql_name), history_columns(batch.columns), small=True), "simple")
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert measure(batch).rows == 1


FIRST = [(1, "10", "a", "c", 1), (2, None, "b", "c", 1), (3, "7", "c", None, None)]
SECOND = [(1, "10", "a", "c", 1), (2, None, "b", "c", 1), (2, None, "b", "c", 1), (4, "1", "d", "u", 5), (5, None, None, "u", None)]


@pytest.mark.parametrize("lost_in", ["stage_rows", "add_staged", "_move_in", "rename"])
@pytest.mark.parametrize("retry", ["same", "next"])
def test_a_lost_driver_neither_loses_nor_repeats_rows(spark, tmp_path, monkeypatch, lost_in, retry):
    """Before the rows are complete, before they are noted, before they are moved, and half way; with null rows."""
    a_feed = feed(batch_ledger=True)
    hist = tables(spark, rows(spark, *FIRST).drop("_offset"), a_feed, tmp_path).history

    def apply(batch, number):
        return apply_history_batch(
            spark, rows(spark, *batch), hist, a_feed.transport, a_feed.key_cols, delivery=Delivery("q", number)
        )

    apply(FIRST, 0)

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        if lost_in == "stage_rows":
            written = history_step.stage_rows
            broken.setattr(history_step, "stage_rows", lambda *a: die(written(*a)))
        elif lost_in == "rename":
            listed = history_step.add_partitions

            def some_moved(session, table, folders):
                listed(session, table, folders)
                note = history_step.properties(session, table)[history_step.ADDING].partition("|")[2]
                path = session._jvm.org.apache.hadoop.fs.Path
                files = path(note).getFileSystem(session._jsc.hadoopConfiguration())
                for place in folders[:1]:
                    for name in [s.getPath().getName() for s in files.listStatus(path(f"{note}/{place}"))]:
                        files.mkdirs(path(f"{table.location}/{place}"))
                        assert files.rename(path(f"{note}/{place}/{name}"), path(f"{table.location}/{place}/{name}"))
                die()

            broken.setattr(history_step, "add_partitions", some_moved)
        else:
            broken.setattr(history_step, lost_in, die)
        with pytest.raises(RuntimeError, match="driver lost"):
            apply(SECOND, 1)

    noted = lost_in in ("_move_in", "rename")
    if retry == "same" or not noted:
        assert apply(SECOND, 1).skipped == noted
    apply([(9, "9", "z", "c", 9)], 2)
    null_rows = [(2, None, "b", "c", 1)] * 3 + [(3, "7", "c", None, None), (5, None, None, "u", None)]
    assert stored(spark, hist) == sorted([(1, "10", "a", "c", 1), (4, "1", "d", "u", 5), (9, "9", "z", "c", 9), *null_rows], key=repr)


def test_staged_rows_of_an_unpartitioned_table(spark, tmp_path):
    from tidemark.sources.tables import create_table

    table = create_table(spark, f"plain_{tmp_path.name.replace('-', '_')}", "id BIGINT, price STRING, name STRING, op_type STRING, ds DATE", f"{tmp_path}/plain")
    for number in (0, 0, 1):
        apply_history_batch(spark, rows(spark, *FIRST), table, ("_offset",), delivery=Delivery("q", number))
    assert len(stored(spark, table)) == 5  # the two rows with nulls come again in batch 1
