"""Embedding near-dedup by sorted projection passes.

Two vectors of one label link when their cosine, in double precision, is at least ``COSINE``.

1. Equal vectors of a label become one row with a count; its id is their least.
2. A pass hashes every vector by the signs of ``BITS`` random projections of its own, concatenated, and
   orders all vectors by label and hash. Each is compared with the next ``WINDOW`` in that order, by exact
   cosine. Neighbours in the order agree on about log2(vectors / WINDOW) leading signs, so a pass misses a
   pair at the threshold with a known probability; the number of passes follows from the vectors of the
   largest label, so that all together miss at most ``MISS`` of such pairs, whatever the size of the table.
3. Verified pairs are united across passes: within a task to a star per group, then by components.
4. Windows are bounded, groups are not. So within every component all pairs are compared after all, in
   square blocks of ``BLOCK`` vectors, and only counted: links per vector come out, never pairs.

The order is dealt over tasks by ranges of (pass, label, hash, id), so neither a label, nor a hash value,
nor a group of copies is bound to one task. What is compared across the edge of two ranges is their first
and last ``WINDOW`` rows, put together by position. Blocks of a component are dealt out by pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label or id,
link with nothing: 0 links, their own id as component, kept. Vectors of different lengths do not link.
Repeated rows are vectors of their own, linked with each other; an id repeated over several vectors is in
one component. Ties of order go by id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.tables import kept, shrink

COSINE = 0.98
BITS = 62
WINDOW = 64
MISS = 1e-3
BLOCK = 2048
SEED = 11
# Vectors of small components compared in one call, and rows of a range, about.
PACK = 4096
RANGE_ROWS = 1 << 15


def passes_for(vectors: int, window: int = WINDOW, cosine: float = COSINE, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with a probability of at most ``miss``."""
    leading = math.ceil(math.log2(max(vectors / window, 2)))
    met = (1 - math.acos(cosine) / math.pi) ** leading
    return max(1, math.ceil(math.log(miss) / math.log(1 - met)))


# Rows and matrices ---------------------------------------------------------------


def _units(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in doubles, a row each, of vectors of ``dim`` floats or doubles."""
    kind = np.float64 if len(raw[0]) == 8 * dim else np.float32
    matrix = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), dim).astype(np.float64)
    # Scaled first, so that neither very large nor very small entries leave the range when squared.
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


_VECTORS = "vec_id long, label string, dim int, digest binary, raw binary"


def _prepared(kind: type):
    """Digest and bytes of every vector that can link; null for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)  # null entries are NaN
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            named = pc.and_(pc.is_valid(batch.column("label")), pc.is_valid(batch.column("vec_id"))).to_pylist()
            digests, raws = [], []
            for end, length, known in zip(np.cumsum(lengths), lengths, named, strict=True):
                entries = flat[end - length : end]
                links = known and length and np.isfinite(entries).all() and entries.any()
                raw = entries.tobytes() if links else None
                raws.append(raw)
                digests.append(hashlib.blake2b(raw, digest_size=16).digest() if links else None)
            arrays = [
                batch.column("vec_id"), batch.column("label"), pa.array(lengths, pa.int32()),
                pa.array(digests, pa.binary()), pa.array(raws, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "dim", "digest", "raw"])

    return run


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, dim, digest, raw: one row per row; digest and raw are null where nothing can link."""
    floats = embeddings.schema["embedding"].dataType == T.ArrayType(T.FloatType(), embeddings.schema["embedding"].dataType.containsNull)
    plain = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<float>" if floats else "array<double>").alias("vector"),
    )
    return plain.mapInArrow(_prepared(np.float32 if floats else np.float64), _VECTORS)


# Passes --------------------------------------------------------------------------

_HASHED = "run int, label string, dim int, hash long, id long, raw binary"


def _hashes(passes: int, bits: int, seed: int):
    """Every vector once per pass, with that pass's hash."""
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.left_shift(1, np.arange(bits - 1, -1, -1), dtype=np.int64)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            raw = batch.column("raw").to_pylist()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((passes, int(dim), bits))
                units = _units([raw[k] for k in rows], int(dim))
                some = batch.take(pa.array(rows))
                for k in range(passes):
                    hashed = ((units @ planes[dim][k]) > 0) @ weights
                    arrays = [
                        pa.array(np.full(len(rows), k, np.int32)), some.column("label"), some.column("dim"),
                        pa.array(hashed), some.column("id"), some.column("raw"),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["run", "label", "dim", "hash", "id", "raw"])

    return run


def _groups(rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the least row that pairs (a, b) connect it with."""
    root = np.arange(rows)
    while True:
        one, two = root[a], root[b]
        low, high = np.minimum(one, two), np.maximum(one, two)
        live = low < high
        if not live.any():
            return root
        np.minimum.at(root, high[live], low[live])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def _neighbours(keys: list[tuple], raw: list[bytes], window: int, cosine: float, edge: int | None = None):
    """Rows (a, b) that link, b among the next ``window`` of a with the same key (run, label, dim).

    With ``edge`` only pairs across it."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    begin = 0
    while begin < len(keys):
        end = begin + 1
        while end < len(keys) and keys[end] == keys[begin]:
            end += 1
        units = _units(raw[begin:end], keys[begin][2])
        for step in range(1, min(window, len(units) - 1) + 1):
            near = np.flatnonzero(np.einsum("ij,ij->i", units[:-step], units[step:]) >= cosine) + begin
            if edge is not None:
                near = near[(near < edge) & (near + step >= edge)]
            if len(near):
                found.append((near, near + step))
        begin = end
    none = np.zeros(0, np.int64)
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (none, none)


# kind 0: a link (a, b); kind 1: the task's number (a) and its rows (b); kind 2: a row near an end of the
# task, by task (a) and place (b).
_FOUND = "kind int, a long, b long, run int, label string, dim int, id long, raw binary"


def _record(kind: int, a, b, more: list[tuple] | None = None) -> pa.RecordBatch:
    n = len(a)
    extra = list(zip(*more, strict=True)) if more else [[None] * n] * 5
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    arrays = [pa.array([kind] * n, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    arrays += [pa.array(list(x), k) for x, k in zip(extra, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "a", "b", "run", "label", "dim", "id", "raw"])


def _compared(window: int, cosine: float):
    """Rows of a range in order: links between neighbours, and the rows that neighbours of other ranges need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        carried: list[tuple] = []
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_pylist() for c in ("run", "label", "dim", "id", "raw")]
            fresh = list(zip(*columns, strict=True))
            if seen < window:
                head = fresh[: window - seen]
                yield _record(2, [task] * len(head), list(range(seen, seen + len(head))), head)
            rows = carried + fresh
            a, b = _neighbours([r[:3] for r in rows], [r[4] for r in rows], window, cosine)
            if len(a):
                root = _groups(len(rows), a, b)
                joined = np.flatnonzero(root != np.arange(len(rows)))
                yield _record(0, [rows[k][3] for k in root[joined]], [rows[k][3] for k in joined])
            seen += len(fresh)
            carried = rows[-window:]
        if seen > window:
            tail = carried[-min(window, seen - window) :]
            yield _record(2, [task] * len(tail), list(range(seen - len(tail), seen)), tail)
        if seen:
            yield _record(1, [task], [seen])

    return run


def _at_edges(starts: dict[int, int], window: int):
    """End rows once for every edge of two ranges within ``window``, with their place in the whole order."""
    edges = np.array(sorted(starts.values())[1:], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tasks, places = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            at = np.array([starts[int(t)] for t in tasks], dtype=np.int64) + places
            low, high = np.searchsorted(edges, at - window, side="right"), np.searchsorted(edges, at + window, side="right")
            rows = np.repeat(np.arange(len(at)), high - low)
            which = np.concatenate([edges[x:y] for x, y in zip(low, high, strict=True)]) if len(at) else edges[:0]
            some = batch.take(pa.array(rows, pa.int64()))
            arrays = [pa.array(which), pa.array(at[rows]), *[some.column(c) for c in ("run", "label", "dim", "id", "raw")]]
            yield pa.RecordBatch.from_arrays(arrays, ["edge", "at", "run", "label", "dim", "id", "raw"])

    return run


def _across(window: int, cosine: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", kind="stable")
        keys = list(zip(frame["run"], frame["label"], frame["dim"], strict=True))
        edge = int((frame["at"] < key[0]).sum())
        a, b = _neighbours(keys, list(frame["raw"]), window, cosine, edge)
        ids = frame["id"].to_numpy()
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    return run


def window_links(
    classes: DataFrame, count: int, passes: int, window: int = WINDOW, cosine: float = COSINE, seed: int = SEED
) -> DataFrame:
    """Links (a, b) that connect what the sorted passes find among (label, dim, id, raw)."""
    ranges = max(1, -(-count * passes // RANGE_ROWS))
    hashed = classes.select("label", "dim", "id", "raw").mapInArrow(_hashes(passes, BITS, seed), _HASHED)
    order = ["run", "label", "dim", "hash", "id"]
    ordered = hashed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    found = kept(ordered.mapInArrow(_compared(window, cosine), _FOUND), "neighbours")
    links = found.where("kind = 0").select("a", "b")
    # One number per range.
    sizes = {r["a"]: r["b"] for r in found.where("kind = 1").select("a", "b").collect()}
    if len(sizes) < 2:
        return links
    starts, at = {}, 0
    for task in sorted(sizes):
        starts[task] = at
        at += sizes[task]
    schema = "edge long, at long, run int, label string, dim int, id long, raw binary"
    near = found.where("kind = 2").drop("kind").mapInArrow(_at_edges(starts, window), schema)
    return links.unionByName(near.groupBy("edge").applyInPandas(_across(window, cosine), "a long, b long"))


# Exact counts within components --------------------------------------------------


def _counted(cosine: float):
    """Links per vector: between the two sides of a block pair, or within a block or a pack of components."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids, sums = [], []
        for _, comp in frame.groupby("comp", sort=False):
            dim, copies, side = int(comp["dim"].iloc[0]), comp["copies"].to_numpy(np.float64), comp["side"].to_numpy()
            units, names = _units(list(comp["raw"]), dim), comp["id"].to_numpy()
            if key[2] == key[3]:
                linked = (units @ units.T >= cosine).astype(np.float64)
                np.fill_diagonal(linked, 0.0)
                ids.append(names)
                sums.append(linked @ copies)
            else:
                left, right = side == 0, side == 1
                linked = (units[left] @ units[right].T >= cosine).astype(np.float64)
                ids += [names[left], names[right]]
                sums += [linked @ copies[right], copies[left] @ linked]
        return pd.DataFrame({"id": np.concatenate(ids), "links": np.concatenate(sums).astype(np.int64)})

    return run


def links_within(members: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(id, links): rows linked with every row of (comp, id, dim, copies, raw) within its component.

    Components of one block are compared whole, many in one call; larger ones by pairs of blocks.
    """
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("m"))
    sizes = kept(sizes.select(F.col("comp").alias("c"), "m", F.ceil(F.col("m") / block).cast("int").alias("blocks")), "component-sizes")
    total, n = sizes.agg(F.coalesce(F.sum("m"), F.lit(0)), F.count(F.lit(1))).first()
    sized = members.join(shrink(sizes.drop("m"), n), F.col("comp") == F.col("c"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(own, k).alias("lo"), F.greatest(own, k).alias("hi"), (own > k).cast("int").alias("side")),
    )
    columns = ["comp", "id", "dim", "copies", "raw"]
    packs = max(1, -(-total // PACK))
    large = F.when(F.col("blocks") > 1, F.col("comp"))
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(packs)))
    dealt = sized.select(*columns, large.alias("large"), pack.alias("pack"), F.explode(pairs).alias("p"))
    dealt = dealt.select(*columns, "large", "pack", "p.lo", "p.hi", "p.side")
    counted = dealt.groupBy("large", "pack", "lo", "hi").applyInPandas(_counted(cosine), "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(embeddings: DataFrame, window: int = WINDOW, passes: int | None = None, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of (vec_id, embedding, label)."""
    rows = kept(vectors_of(embeddings), "vectors")
    alike = ["label", "dim", "digest"]
    known = rows.where("digest IS NOT NULL")
    # One row per vector, with its least id; copies meet within map tasks first. A number of its own names
    # it, as an id may be repeated over several vectors.
    grouped = known.groupBy(*alike).agg(F.min(F.struct("vec_id", "raw")).alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = grouped.select(*alike, F.col("first.vec_id").alias("least"), F.col("first.raw").alias("raw"), "copies", F.monotonically_increasing_id().alias("id"))
    classes = kept(classes, "classes")
    largest = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    links = kept(window_links(classes, classes.count(), passes or passes_for(largest, window), window), "links")
    comps = kept(components(links), "comps")
    member = kept(comps.unionByName(comps.select(F.col("component").alias("node"), "component").distinct()), "member")
    near = classes.join(shrink(member, member.count()), F.col("id") == F.col("node")).withColumnRenamed("component", "comp")
    counts = kept(links_within(near.select("comp", "id", "dim", "copies", "raw"), block=block), "counts")
    # An id with several vectors holds their components together.
    spread = known.groupBy("vec_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.min("label").alias("l1"), F.max("label").alias("l2"))
    spread = kept(spread.where("lo <> hi OR l1 <> l2").select(F.col("vec_id").alias("wide")), "wide-ids")
    if n := spread.count():
        ties = known.join(shrink(spread, n), F.col("vec_id") == F.col("wide")).select("vec_id", *alike).distinct()
        ties = ties.join(classes.select(*alike, "id"), alike).select("vec_id", "id")
        ties = ties.join(ties.groupBy("vec_id").agg(F.min("id").alias("a")), "vec_id").select("a", F.col("id").alias("b"))
        comps = kept(components(links.unionByName(ties)), "comps")
    # The least id of every component; only vectors with copies or in a component need looking up.
    placed = classes.join(comps, F.col("id") == F.col("node"), "left").select(*alike, "id", "least", "copies", F.coalesce("component", "id").alias("comp"))
    placed = kept(placed, "placed")
    shared = placed.groupBy("comp").agg(F.min("least").alias("root"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    told = (
        placed.join(shared, "comp", "left")
        .where("root IS NOT NULL OR copies > 1")
        .join(counts.withColumnRenamed("links", "n"), "id", "left")
        .select(*alike, F.coalesce("root", "least").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    told = kept(told, "told")
    told = told.select(*[F.col(c).alias(f"t_{c}") for c in alike], "root", "links")
    same = (F.col("digest") == F.col("t_digest")) & (F.col("dim") == F.col("t_dim")) & (F.col("label") == F.col("t_label"))
    return (
        known.join(shrink(told, told.count()), same, "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
        .unionByName(rows.where("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
