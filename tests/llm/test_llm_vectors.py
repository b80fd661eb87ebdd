"""Embedding near-dedup and whitening against plain numpy."""

import numpy as np
import pytest

from llm_fixtures import ROOT, needs_tables
from tidemark.llm import embedding_dedup, whitening

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, n BIGINT, comp STRING, id INT, raw STRING, digest INT"
MORE = (1, "x", 2, "y", 3)


def vectors(seed: int = 5, dim: int = 16) -> list[tuple]:
    """Random vectors, near copies at many distances, exact copies, scaled ones and everything awkward."""
    rng = np.random.default_rng(seed)
    rows = []

    def add(vector, label):
        rows.append((len(rows), None if vector is None else [float(x) for x in np.float32(vector)], label))

    for k in range(60):
        base = rng.standard_normal(dim)
        add(base, k % 3)
        for _ in range(k % 4):
            add(base + rng.standard_normal(dim) * rng.uniform(0.02, 0.12) * np.sqrt(16 / dim), k % 3 if k % 5 else (k + 1) % 3)
    centre = rng.standard_normal(dim)
    for _ in range(150):
        add(centre + rng.standard_normal(dim) * 0.1, 1)
    for _ in range(40):
        add(centre, 1)
    add(centre * 7, 1)
    add(np.zeros(dim), 1)
    add(np.zeros(dim), 1)
    add(None, 1)
    add([], 1)
    add([np.nan, *centre[1:]], 1)
    add([np.inf, *centre[1:]], 1)
    add(centre, None)
    add(centre[:5], 1)
    add(centre[:5] * 2, 1)
    add([1e30, *np.zeros(dim - 1)], 0)
    add([3e-39, *np.zeros(dim - 1)], 0)
    rows.append((len(rows), [None, *[1.0] * (dim - 1)], 1))
    rows.append((7, [float(x) for x in np.float32(centre)], 1))  # an id with two vectors
    rows.append((8, rows[8][1], rows[8][2]))  # a repeated row
    rows.append((None, [float(x) for x in np.float32(centre)], 1))
    return rows


def brute(rows: list[tuple]) -> list[tuple]:
    def fine(row):
        v = row[1]
        return row[0] is not None and row[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = {}
    for k, row in enumerate(rows):
        if fine(row):
            v = np.array(row[1], dtype=np.float64)
            v /= np.abs(v).max()
            units[k] = v / np.linalg.norm(v)
    links = [0] * len(rows)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i in units:
        for j in units:
            same = rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
            if i < j and same and units[i] @ units[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                a, b = find(rows[i][0]), find(rows[j][0])
                parent[max(a, b)] = min(a, b)
    return [(r[0], links[k], find(r[0]) if k in units else r[0]) for k, r in enumerate(rows)]


def test_near_duplicates_equal_all_pairs(spark):
    rows = vectors()
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA).repartition(5)
    # Small blocks, so that the large group meets by pairs of blocks.
    got = embedding_dedup.near_duplicates(frame, block=32).collect()
    wanted = brute(rows)
    assert sorted(map(repr, [(r["vec_id"], r["n_links"], r["component_id"]) for r in got])) == sorted(map(repr, wanted))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_recall_with_a_narrow_window(spark):
    """Few neighbours, many ranges: what windows miss within a component is counted all the same."""
    rows = vectors(9)
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA).repartition(5)
    got = embedding_dedup.near_duplicates(frame, window=4).collect()
    assert sum(r["n_links"] for r in got) >= 0.9 * sum(w[1] for w in brute(rows))


def test_edges_of_ranges_lose_no_neighbour(spark, monkeypatch):
    rows = vectors(3)
    monkeypatch.setattr(embedding_dedup, "RANGE_ROWS", 8)
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA)
    got = embedding_dedup.near_duplicates(frame).collect()
    assert sorted(map(repr, [(r["vec_id"], r["n_links"], r["component_id"]) for r in got])) == sorted(map(repr, brute(rows)))


def test_passes_follow_the_table():
    assert embedding_dedup.passes_for(0) >= 1
    assert embedding_dedup.passes_for(10**4) < embedding_dedup.passes_for(10**9) < 100


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_duplicates(empty).collect() == []
    assert whitening.whiten(empty).collect() == []
    lone = spark.createDataFrame([(1, [1.0, 2.0], 0, *MORE)], SCHEMA)
    assert [tuple(r) for r in embedding_dedup.near_duplicates(lone).collect()] == [(1, 0, 1, True)]
    assert whitening.whiten(lone).collect() == []


def plain_axes(x: np.ndarray):
    away = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(away.T @ away / len(x))
    return values[::-1], axes[:, ::-1], away


@pytest.mark.parametrize("dim", [3, 40])
def test_whitening_equals_an_eigensolver(spark, dim):
    rng = np.random.default_rng(dim)
    data = (rng.standard_normal((300, dim)) @ rng.standard_normal((dim, dim))).astype(np.float32)
    rows = [(k, [float(v) for v in row], None) for k, row in enumerate(data)]
    odd = [(1000, None, 1), (1001, [None] * dim, 1), (1002, [float("nan")] * dim, 1), (1003, [1.0], 1), (None, rows[0][1], 1), (3, rows[3][1], 1)]
    odd += [(1004, [float("inf")] * dim, 1), (1005, [3e38] * dim, 1)]
    frame = spark.createDataFrame([(*r, *MORE) for r in rows + odd], SCHEMA).repartition(4)
    got = whitening.whiten(frame).toPandas()
    used = [*rows, *odd[4:6]]
    x = np.floor(64 * np.array([r[1] for r in used], dtype=np.float64)) + 1_000_000
    values, axes, away = plain_axes(x)
    n, k = len(used), min(32, dim)
    assert len(got) == n * k and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    sums = [int(s) for s in x.sum(axis=0)]
    for at, (vec_id, _, _) in enumerate(used[:20]):
        mine = got[got["vec_id"] == vec_id].drop_duplicates().sort_values("component")
        assert set(mine["deviation"]) == {sum((n * int(v) - s) ** 2 for v, s in zip(x[at], sums, strict=True))}
        share = mine["explained"].to_numpy()[:k]
        assert np.allclose(share, (values / values.sum())[:k], rtol=1e-9)
    flat = got[got["vec_id"].notna() & (got["vec_id"] != 3)].pivot(index="vec_id", columns="component", values="whitened")
    plain = {r[0]: away[at] @ axes[:, :k] / np.sqrt(values[:k]) for at, r in enumerate(used)}
    wanted = np.array([plain[v] for v in flat.index])
    sign = np.sign((flat.to_numpy() * wanted).sum(axis=0))
    assert np.allclose(flat.to_numpy(), wanted * sign, atol=1e-7)


def test_fewer_vectors_than_entries(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(v) for v in rng.standard_normal(20).astype(np.float32)], 0, *MORE) for k in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert sorted(set(got["component"])) == [1, 2, 3, 4, 5] and got["identity_error"].max() < 1e-9
    assert abs(got.groupby("component")["explained"].first().sum() - 1) < 1e-12
    same = spark.createDataFrame([(k, [1.0, 2.0], 0, *MORE) for k in range(6)], SCHEMA)
    assert whitening.whiten(same).collect() == []


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    half = rng.standard_normal((12, 7))
    scatter = half @ half.T
    factor = whitening.pivoted_cholesky(scatter)
    assert factor.shape == (12, 7) and np.allclose(factor @ factor.T, scatter)
    turned = whitening.orthogonal_columns(factor)
    gram = turned.T @ turned
    assert np.allclose(gram, np.diag(gram.diagonal()), atol=1e-12 * gram.max())
    assert np.allclose(np.sort(gram.diagonal()), np.linalg.eigvalsh(scatter)[-7:])


def test_large_counts_keep_deviations_exact():
    x = np.array([[1, 5], [1 << 40, 7]], dtype=np.int64)
    n, total = 10**6, np.array([10**6 * 3 + 1, 10**6 * 4 + 2], dtype=np.int64)
    got = whitening._deviations(x, total // n, total % n, n)
    assert [int(g) for g in got] == [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total, strict=True)) for row in x]


@needs_tables
def test_table_has_no_false_links(spark):
    from tidemark.llm.queries import op11_embedding_dedup

    frame = spark.read.parquet(f"{ROOT}/embeddings.parquet").collect()
    wanted = brute([(r["vec_id"], r["embedding"], r["label"]) for r in frame])
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in op11_embedding_dedup(spark, ROOT).collect()]
    assert sorted(got) == sorted(wanted)
