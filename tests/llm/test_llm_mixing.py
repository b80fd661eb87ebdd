import re
from collections import defaultdict

import pytest

from llm_fixtures import as_rows, empty, messy, plain_texts, prose
from tidemark.llm.mixing import apportion, mix


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def targets(sizes, weights=(5, 2, 1)):
    """Share by weight, stop at three times the size, share the excess anew."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and rest * weight[s] / open_weight > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        full |= over


def check(docs, rows, tolerance=80):
    got = mix(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    wanted = targets(sizes)
    source_of = {(d, size_of(t)): s for d, t, s in rows}
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        source = source_of[(r["doc_id"], r["size"])]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(wanted[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= tolerance
    return sorted(map(tuple, got), key=repr)


def test_messy_table_meets_its_targets_and_reruns_agree(spark):
    docs = messy(spark)
    assert check(docs, plain_texts()) == sorted(map(tuple, mix(docs.repartition(7)).collect()), key=repr)
    assert mix(empty(spark)).count() == 0


def test_many_shards(spark):
    rows = [(k, prose(k, 1 + k % 37), f"s{k % 3}" if k % 5 else "hot") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    small = mix(docs, shard_words=500, shard_rows=20, block=8)
    taken, wanted = defaultdict(int), {}
    for r in small.collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        source = rows[r["doc_id"]][2]
        taken[source] += r["taken"]
        wanted[source] = r["target"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 8 + 0.02 * target


def seats(shares, n):
    """Sainte-Lague one seat at a time."""
    won = [0] * len(shares)
    for _ in range(n):
        best = max(range(len(shares)), key=lambda k: (shares[k] / (2 * won[k] + 1), -k))
        won[best] += 1
    return won


@pytest.mark.parametrize("shares,n", [([5.0, 3.0, 1.0], 7), ([1.0] * 7, 3), ([100.0, 1.0, 1.0, 1.0], 10), ([3.0, 0.0, 2.0], 5), ([53.0, 24.0, 23.0] + [0.4] * 40, 25), ([2.5], 4), ([1.0, 2.0], 0)])
def test_apportionment_equals_seat_by_seat(spark, shares, n):
    df = spark.createDataFrame([(0, k, s, n) for k, s in enumerate(shares)], "g INT, k INT, share DOUBLE, seats INT")
    got = as_rows(apportion(df, ["g"], "share", "seats", ["k"], "won"), "k", "won")
    assert [w for _, w in got] == [w for _, w in sorted(enumerate(seats(shares, n)), key=repr)]


def test_rows_without_an_id_spread_over_shards(spark):
    from tidemark.llm import mixing

    rows = [(None, "a b c", "s")] * 4000 + [(7, "a b", "s")] * 1000 + [(k, "w " * 5, "t") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    seen = []
    plain = mixing._draw

    def draw(seed, block, most):
        inner = plain(seed, block, most)
        return lambda key, frame: inner(key, frame).assign(taken=len(frame))

    mixing._draw = draw
    try:
        seen = [r["taken"] for r in mixing.mix(docs, shard_rows=500).collect()]
    finally:
        mixing._draw = plain
    assert len(seen) == len(rows) and max(seen) < 1000
    assert as_rows(mix(docs, shard_rows=500), "doc_id", "size", "taken") == as_rows(mix(docs.repartition(7), shard_rows=500), "doc_id", "size", "taken")
