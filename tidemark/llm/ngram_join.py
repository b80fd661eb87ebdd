"""N-gram Jaccard join over a blocked sparse document by n-gram incidence matrix.

A document's set is its distinct shingles of five words (A-Z lower-cased); with fewer words, the whole
sequence as one; without words, empty and linked with nothing. Two documents link when
100 * |both| >= 80 * |either|, which is |both| >= 4 (n_a + n_b) / 9.

1. One pass gives every document its size and a fingerprint of its set, and counts n-grams in a fixed
   table of 2^22 cells. Documents with the same set are one row of the matrix from here on.
2. Columns (n-grams) are ordered by the count of their cell, then by hash, rare ones first. A
   linked pair shares a column among the first n - ceil(0.8 n) + 1 of each row, and its first shared
   column leaves enough to come on either side. Only these entries are shuffled, by column; a block of
   columns is one task. Columns met once are dropped there.
3. In every column the row with the fewest rarer n-grams is the hub. Rows are multiplied with their
   hubs: first by sketches of 256 counts, then by whole sets, accumulated stripe by stripe; a pair is
   discarded as soon as its overlap so far plus what is left falls below the bound of its sizes. What
   remains is linked exactly. (So blocks of columns give the candidate pairs, and the overlap of a pair is
   summed over its own two rows, not carried through the blocks: a product over all columns would emit every
   pair of a group of copies once per block.)
4. Pairs that share a column but are not yet in one component are multiplied the same way, so that
   no link is lost, while a group of copies never meets itself pair by pair.

Columns whose cell is crowded are split by a hash of the row, and their hubs meet once more. Only a
column held by rows of several components gives pairs in step 4. Null and empty texts have size 0 and
their own id as component. A doc_id repeated over several texts links by each of them and is
in one component; rows without doc_id link with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import partsum
from tidemark.llm.components import components
from tidemark.llm.tables import BROADCAST_NUMBERS, documents, kept, shrink
from tidemark.llm.textops import shingles_of, text_chunks

WIDTH = 5
CELLS = 1 << 22
ENTRIES_PER_BLOCK = 1 << 19
SPLIT_CLASS = 12  # columns with more than about 2^12 rows are split
STRIPES = 4
FLUSH = 1 << 18
SKETCH = 256  # counts per row, by a part of the hash, each up to 255


def _row_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes in ascending order) of every text."""
    for lo, hi, data, offsets in text_chunks(column):
        row, hashes = shingles_of(data, offsets, WIDTH)
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        if len(row):
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
            row, hashes = row[new], hashes[new]
        cut = np.searchsorted(row, np.arange(hi - lo + 1))
        for k in range(hi - lo):
            yield lo + k, hashes[cut[k] : cut[k + 1]]


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


_SURVEY = "doc_id long, n long, mark binary, sketch binary, part long, sums binary"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and fingerprint per document; at the end the task's n-gram counts."""
    counts = np.zeros(CELLS, dtype=np.int32)
    waiting, held = [], 0
    names = ["doc_id", "n", "mark", "sketch", "part", "sums"]
    for batch in batches:
        size = np.zeros(batch.num_rows, dtype=np.int64)
        mark, sketch = [b""] * batch.num_rows, [b""] * batch.num_rows
        for row, hashes in _row_sets(batch.column("text")):
            size[row] = len(hashes)
            mark[row] = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            sketch[row] = _sketch(hashes)
            waiting.append(_cell(hashes))
            held += len(hashes)
            if held >= FLUSH:
                _count(counts, waiting)
                waiting, held = [], 0
        none = [pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), pa.array(mark, pa.binary()), pa.array(sketch, pa.binary()), *none], names)
    if waiting:
        _count(counts, waiting)
    yield pa.RecordBatch.from_arrays(
        [
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.binary()),
            pa.nulls(1, pa.binary()),
            pa.array([partsum.part_number()], pa.int64()),
            pa.array([partsum.packed(counts)], pa.binary()),
        ],
        names,
    )


def _count(counts: np.ndarray, cells: list[np.ndarray]) -> None:
    """Add to the one table in place; a task of more than 2^31 n-grams of one cell fails rather than wraps."""
    filled, more = np.unique(np.concatenate(cells), return_counts=True)
    sums = counts[filled] + more
    if sums.max(initial=0) > np.iinfo(counts.dtype).max:
        raise OverflowError("too many n-grams in one task")
    counts[filled] = sums


def _sketch(hashes: np.ndarray) -> bytes:
    counts = np.bincount((hashes >> np.uint64(48)).astype(np.int64) % SKETCH, minlength=SKETCH)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def column_classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class per cell, parts per class): emptier cells have lower classes, in steps of one per cent.

    An n-gram of many documents is in a full cell, and so comes into a prefix only where a set has
    nothing rarer. What can hide among the others grows with n-grams per cell; give a larger corpus
    more ``CELLS``. The order of columns has no bearing on the result, only on the work.

    A class fuller than chance makes it by more than 2^SPLIT_CLASS rows is split into parts.
    """
    classes = np.floor(64 * np.log2(counts + 1.0)).astype(np.uint16)
    mean = counts.mean()
    excess = 2.0 ** (np.arange(4096) / 64) - (mean + 8 * np.sqrt(mean) + 8)
    parts = np.maximum(np.floor(np.log2(np.maximum(excess, 1))) - SPLIT_CLASS, 0)
    return classes, np.left_shift(1, np.minimum(parts, 20).astype(np.int32)).astype(np.int32)


def _prefix(size: int) -> int:
    return size - -(-80 * size // 100) + 1


def _ordered(hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set's hashes and classes in column order (hashes come in ascending)."""
    kind = classes[_cell(hashes)]
    order = np.argsort(kind, kind="stable")
    return hashes[order], kind[order]


_ENTRIES = "col long, split int, doc long, n int, pos int"


def _entries(classes: np.ndarray, parts: np.ndarray):
    """Prefix entries of every row, with the number of parts its column is split into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            cols, splits, docs, sizes, places = [], [], [], [], []

            def flush() -> pa.RecordBatch:
                arrays = [
                    pa.array(np.concatenate(cols).astype(np.uint64).view(np.int64)),
                    pa.array(np.concatenate(splits)),
                    pa.array(np.concatenate(docs)),
                    pa.array(np.concatenate(sizes)),
                    pa.array(np.concatenate(places)),
                ]
                return pa.RecordBatch.from_arrays(arrays, ["col", "split", "doc", "n", "pos"])

            held = 0
            for row, hashes in _row_sets(batch.column("text")):
                size = len(hashes)
                if not size:
                    continue
                p = _prefix(size)
                col, kind = _ordered(hashes, classes)
                cols.append(col[:p])
                splits.append(parts[kind[:p]])
                docs.append(np.full(p, ids[row], dtype=np.int64))
                sizes.append(np.full(p, size, dtype=np.int32))
                places.append(np.arange(p, dtype=np.int32))
                held += p
                if held >= 1 << 16:
                    yield flush()
                    cols, splits, docs, sizes, places, held = [], [], [], [], [], 0
            if held:
                yield flush()

    return run


_SHARED = "col long, split int, doc long, n int, pos int, hub long, hub_n int, hub_pos int"


def _shared_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by column (and part), position and document: entries of columns met more than once.

    The first row of a column is its hub. Between batches only the last column's hub is carried; while it
    is that column's only row it waits, unless the column is split.
    """
    names = ["col", "part", "split", "doc", "n", "pos"]
    hub: dict | None = None
    waiting = False
    for batch in batches:
        if not batch.num_rows:
            continue
        values = {c: batch.column(c).to_numpy() for c in names}
        if hub is not None and waiting:
            values = {c: np.concatenate((np.array([hub[c]], dtype=v.dtype), v)) for c, v in values.items()}
        col, part = values["col"], values["part"]
        goes_on = hub is not None and not waiting and (col[0], part[0]) == (hub["col"], hub["part"])
        new = np.ones(len(col), dtype=bool)
        new[1:] = (col[1:] != col[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        out = (size[group] > 1) | (values["split"] > 1)
        heads = {c: values[c][begin] for c in names}
        if goes_on:
            out[group == 0] = True
            for c in names:
                heads[c][0] = hub[c]
        only = begin[-1]
        waiting = bool(not out[only])
        hub = {c: heads[c][-1] for c in names}
        arrays = [pa.array(values[c][out]) for c in ("col", "split", "doc", "n", "pos")]
        arrays += [pa.array(heads[c][group][out]) for c in ("doc", "n", "pos")]
        yield pa.RecordBatch.from_arrays(arrays, ["col", "split", "doc", "n", "pos", "hub", "hub_n", "hub_pos"])


def _possible(a: str, n_a: str, p_a: str, b: str, n_b: str, p_b: str):
    """Sizes and first shared places that leave room for a link."""
    need = 4 * (F.col(n_a) + F.col(n_b))
    return (9 * F.least(F.col(n_a) - F.col(p_a), F.col(n_b) - F.col(p_b)) >= need) & (F.col(a) != F.col(b))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        rows, sets, held = [], [], 0
        for row, hashes in _row_sets(batch.column("text")):
            rows.append(ids[row].as_py())
            sets.append(hashes.tobytes())
            held += len(sets[-1])
            if held >= 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(sets, pa.binary())], ["doc", "grams"])
                rows, sets, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(sets, pa.binary())], ["doc", "grams"])


def _linked(one: np.ndarray, two: np.ndarray) -> bool:
    """Overlap accumulated over stripes of columns, given up when the bound is out of reach."""
    need = -(-4 * (len(one) + len(two)) // 9)
    if min(len(one), len(two)) < need:
        return False
    edges = (np.arange(1, STRIPES, dtype=np.uint64) * np.uint64((1 << 64) // STRIPES)).astype(np.uint64)
    cut1 = np.concatenate(([0], np.searchsorted(one, edges), [len(one)]))
    cut2 = np.concatenate(([0], np.searchsorted(two, edges), [len(two)]))
    overlap = 0
    for k in range(STRIPES):
        x, y = one[cut1[k] : cut1[k + 1]], two[cut2[k] : cut2[k + 1]]
        if len(x) and len(y):
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            overlap += int(np.count_nonzero(y[at] == x))
        if overlap + min(len(one) - cut1[k + 1], len(two) - cut2[k + 1]) < need:
            return False
    return True


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = batch.column("grams_a"), batch.column("grams_b")
        keep = np.zeros(batch.num_rows, dtype=bool)
        for k in range(batch.num_rows):
            keep[k] = _linked(
                np.frombuffer(one[k].as_buffer(), dtype=np.uint64), np.frombuffer(two[k].as_buffer(), dtype=np.uint64)
            )
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _within_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches leave room for a link: their counts differ by no more than sets that link do.

    The difference of two rows' counts is at most that of their sets, which for a link is at most
    (n_a + n_b) / 9.
    """
    for batch in batches:
        if batch.num_rows:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, SKETCH).astype(np.int16)
                for c in ("sketch_a", "sketch_b")
            )
            apart = np.abs(one - two).sum(axis=1, dtype=np.int64)
            size = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(9 * apart <= size))


def _multiplied(docs: DataFrame, sketches: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: by their sketches first, then by whole sets."""

    def ids(of: DataFrame) -> tuple[DataFrame, int]:
        wanted = kept(of.select(F.explode(F.array("a", "b")).alias("wanted")).distinct(), "wanted")
        return wanted, wanted.count()

    def both(of: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
        left = rows.select(F.col("doc").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
        right = rows.select(F.col("doc").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
        return of.join(left, "a").join(right, "b").select("a", "b", *[f"{c}_{x}" for c in columns for x in "ab"])

    few = shrink(*ids(pairs), BROADCAST_NUMBERS)
    near = both(pairs, sketches.join(few, F.col("doc") == F.col("wanted"), "left_semi"), "n", "sketch")
    near = kept(near.mapInArrow(_within_reach, "a long, b long").distinct(), "near")
    few = shrink(*ids(near), BROADCAST_NUMBERS)
    rows = docs.join(few, F.col("doc_id") == F.col("wanted"), "left_semi").select("doc_id", "text")
    sets = kept(rows.mapInArrow(_set_bytes, "doc long, grams binary"), "sets")
    return kept(both(near, sets, "grams").mapInArrow(_products, "a long, b long").distinct(), "linked")


def jaccard_links(
    reps: DataFrame, sketches: DataFrame, total_shingles: int, classes: tuple[np.ndarray, np.ndarray]
) -> DataFrame:
    """Links (a, b) that connect all documents of a component.

    ``reps`` has doc_id and text, ``sketches`` doc, n and sketch.
    """
    blocks = max(1, -(-total_shingles // (5 * ENTRIES_PER_BLOCK)))
    entries = reps.mapInArrow(_entries(*classes), _ENTRIES)
    part = F.when(F.col("split") > 1, F.pmod(F.xxhash64("doc"), F.col("split"))).otherwise(0).cast("int")
    placed = (
        entries.withColumn("part", part)
        .repartition(max(blocks, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "col", "part")
        .sortWithinPartitions("col", "part", "pos", "doc")
    )
    shared = kept(placed.mapInArrow(_shared_columns, _SHARED), "shared")
    hubs = shared.where(_possible("hub", "hub_n", "hub_pos", "doc", "n", "pos")).select(*_pair("hub", "doc"))
    # Hubs of one split column meet its least hub.
    parts = shared.where("split > 1").select("col", "hub", "hub_n", "hub_pos").distinct()
    tops = parts.groupBy("col").agg(F.min(F.struct("hub_pos", "hub", "hub_n")).alias("top"))
    met = parts.join(tops, "col").select("hub", "hub_n", "hub_pos", F.col("top.hub").alias("t"), F.col("top.hub_n").alias("tn"), F.col("top.hub_pos").alias("tp"))
    met = met.where(_possible("hub", "hub_n", "hub_pos", "t", "tn", "tp")).select(*_pair("hub", "t"))
    tried = kept(hubs.unionByName(met).distinct(), "tried")
    links = _multiplied(reps, sketches, tried)
    # What is left: columns that hold rows of several components.
    comps = components(links)
    named = shared.join(comps, F.col("doc") == F.col("node"), "left").select(
        "col", "doc", "n", "pos", F.coalesce("component", "doc").alias("comp")
    )
    mixed = named.groupBy("col", "comp").agg(F.count(F.lit(1)).alias("m"))
    tops = mixed.groupBy("col").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("all"))
    tops = kept(tops.where("comps > 1 AND NOT (all = 2)").select(F.col("col").alias("c"), F.col("top.comp").alias("top")), "mixed")
    held = kept(named.join(tops, F.col("col") == F.col("c")).drop("c"), "held")
    few = held.where("comp <> top").select("col", *[F.col(c).alias(f"x_{c}") for c in ("doc", "n", "pos", "comp")])
    cross = few.join(held, "col").where(
        (F.col("x_comp") != F.col("comp"))
        & ((F.col("comp") == F.col("top")) | (F.col("x_doc") < F.col("doc")))
        & _possible("x_doc", "x_n", "x_pos", "doc", "n", "pos")
    )
    rest = cross.select(*_pair("x_doc", "doc")).distinct().join(tried, ["a", "b"], "left_anti")
    return links.unionByName(_multiplied(reps, sketches, kept(rest, "rest")))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    plain = documents(docs)
    survey = kept(plain.mapInArrow(_survey, _SURVEY), "survey")
    classes = column_classes(partsum.total(survey.where("part IS NOT NULL").select("part", "sums"), CELLS))
    rows = survey.where("part IS NULL").select("doc_id", "n", "mark", "sketch")
    known = rows.where("doc_id IS NOT NULL AND n > 0")
    # One representative per set; an id repeated over several texts represents none but its first.
    sets = kept(known.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "classes")
    spare = kept(
        known.join(sets.where("copies > 1").select("mark", "rep"), "mark")
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("spare"))
        .distinct()
        .join(sets.select(F.col("rep").alias("spare")), "spare", "left_anti"),
        "spare",
    )
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    reps = plain.where("doc_id IS NOT NULL").join(shrink(spare, spare.count()), F.col("doc_id") == F.col("spare"), "left_anti")
    sketches = known.select(F.col("doc_id").alias("doc"), "n", "sketch")
    links = jaccard_links(reps, sketches, total, classes)
    # All sets of one id belong together, also where the id represents none of them.
    several = known.groupBy("doc_id").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo <> hi")
    several = kept(several.select(F.col("doc_id").alias("several")), "several")
    if n := several.count():
        own = known.join(shrink(several, n), F.col("doc_id") == F.col("several")).select("doc_id", "mark").distinct()
        own = kept(own.join(sets.select("mark", "rep"), "mark").select("doc_id", "rep"), "own-sets")
        ties = own.join(own.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").select("a", F.col("rep").alias("b"))
        links = links.unionByName(ties)
    comps = components(links)
    return (
        rows.join(sets.select("mark", "rep"), "mark", "left")
        .join(comps, F.col("rep") == F.col("node"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", F.when(F.col("n") > 0, F.col("rep")), "doc_id").alias("component_id"))
    )
