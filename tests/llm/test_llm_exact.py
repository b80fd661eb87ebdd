import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import as_rows, empty, messy, plain_texts
from tidemark.llm.exact_dedup import build_filter, dedup, exact_groups, probe_filter, survivors

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def expected(rows):
    groups = defaultdict(list)
    for doc, text, _ in rows:
        groups[hashlib.sha256(text.encode().lower()).hexdigest()].append(doc)
    out = []
    for sha, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        taken = False
        for doc in ids:
            stays = doc == keep and not taken
            taken |= stays
            out.append((doc, keep, len(ids), stays, sha))
    return sorted(out, key=repr)


def test_groups_equal_brute_force(spark):
    assert as_rows(dedup(messy(spark)), *COLUMNS) == expected(plain_texts())


@pytest.mark.parametrize("cut", [0, 9, 100])
def test_any_cut_into_snapshot_and_batch_gives_the_same(spark, cut):
    docs = messy(spark)
    old = docs.where(f"doc_id < {cut}")
    new = docs.where(f"doc_id >= {cut} OR doc_id IS NULL")
    assert as_rows(exact_groups(old, new), *COLUMNS) == expected(plain_texts())


def test_survivors_keep_one_row_per_text_and_all_columns(spark):
    docs = messy(spark)
    left = survivors(docs)
    assert left.columns == docs.columns
    wanted = Counter((d, s) for d, _, _, k, s in expected(plain_texts()) if k)
    got = Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode().lower()).hexdigest()) for r in left.collect())
    assert got == wanted


def test_empty_table(spark):
    assert dedup(empty(spark)).count() == 0 and survivors(empty(spark)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 17, 1000, 60_000])
def test_filter_has_no_false_negative_and_few_false_positives(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    seed, segment, segments, table = build_filter(keys)
    assert probe_filter(keys, seed, segment, segments, table).all()
    others = rng.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)
    assert probe_filter(others, seed, segment, segments, table).mean() < 0.001
    if n > 1000:
        assert table.nbytes < 2 * 1.4 * n
