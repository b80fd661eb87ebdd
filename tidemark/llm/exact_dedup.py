"""Exact deduplication of a batch against an immutable snapshot.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Every text becomes a
SHA-256 digest once. The snapshot's distinct digests are cut into buckets by their leading bits, and
each bucket gets a static binary-fuse filter. Incoming distinct digests are screened bucket by bucket;
what a filter passes is joined with the exact bucket, and the texts behind a match are compared byte
by byte. What no filter passes is new and is grouped within the batch alone. Only digests and ids are
shuffled; texts move only for confirmed candidates.

Repeated rows (same doc_id, same text) count each in group_size and one of them is kept. Rows without
doc_id count too and are never the one that stays unless the whole group has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import ascii_lower, documents, kept, only, shrink, without

# Distinct digests per bucket, and so per filter, on average.
BUCKET_KEYS = 1 << 16
DIGEST_SCHEMA = "doc_id long, digest binary, n_bytes long"


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, sizes = [], []
        for text in batch.column("text"):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
            digests.append(hashlib.sha256(raw).digest())
            sizes.append(len(raw))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())],
            ["doc_id", "digest", "n_bytes"],
        )


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the normalised text, its bytes; one row per document."""
    return documents(docs).mapInArrow(_digest_batches, DIGEST_SCHEMA)


# Binary fuse filter with three positions and 16-bit fingerprints.


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _places(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots per key in neighbouring segments."""
    start = ((hashes >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    base = start * np.uint64(segment)
    size = np.uint64(segment)
    return np.stack(
        [
            base + (hashes & mask),
            base + size + ((hashes >> np.uint64(18)) & mask),
            base + size * np.uint64(2) + ((hashes >> np.uint64(36)) & mask),
        ]
    ).astype(np.int64)


def _marks(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, segments, fingerprints) for distinct 64-bit keys.

    Keys are peeled in waves: every slot that one key alone still uses gives that key away. The
    fingerprints are then set in the reverse order, wave by wave.
    """
    keys = np.unique(keys)
    n = max(len(keys), 1)
    segment = 1 << max(2, min(18, int(np.log(n) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    for attempt in range(64):
        segments = max(1, int(np.ceil(n * factor * (1 + attempt // 8 * 0.1) / segment)))
        slots = (segments + 2) * segment
        seed = 0x2545F4914F6CDD1D + attempt * 0x9E3779B9
        hashes = _mixed(keys, seed)
        places = _places(hashes, segment, segments)
        degree = np.bincount(places.ravel(), minlength=slots)
        owner = np.zeros(slots, dtype=np.int64)
        for row in places:
            np.bitwise_xor.at(owner, row, np.arange(len(keys)))
        alive = np.ones(len(keys), dtype=bool)
        waves: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            slot = np.flatnonzero(degree == 1)
            if not len(slot):
                break
            key, at = np.unique(owner[slot], return_index=True)
            slot = slot[at]
            waves.append((key, slot))
            alive[key] = False
            gone = places[:, key].ravel()
            np.subtract.at(degree, gone, 1)
            np.bitwise_xor.at(owner, gone, np.tile(key, 3))
        if alive.any():
            continue
        table = np.zeros(slots, dtype=np.uint16)
        for key, slot in reversed(waves):
            others = np.bitwise_xor.reduce(table[places[:, key]], axis=0)
            table[slot] = _marks(hashes[key]) ^ others ^ table[slot]
        return seed, segment, segments, table
    raise RuntimeError("no seed peels this bucket")


def probe_filter(keys: np.ndarray, seed: int, segment: int, segments: int, table: np.ndarray) -> np.ndarray:
    hashes = _mixed(keys, seed)
    found = np.bitwise_xor.reduce(table[_places(hashes, segment, segments)], axis=0)
    return found == _marks(hashes)


def _keys(digests: pd.Series) -> np.ndarray:
    if not len(digests):
        return np.zeros(0, dtype=np.uint64)
    joined = np.frombuffer(b"".join(bytes(d) for d in digests), dtype=">u8").reshape(-1, 4)
    return joined[:, 1].astype(np.uint64)


def _bucket(digest: Column, buckets: int) -> Column:
    lead = F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long")
    return F.pmod(lead, F.lit(buckets)).cast("int")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: rows, largest and smallest doc_id."""
    return rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("doc_id").alias("keep_id"),
        F.min("doc_id").alias("witness"),
    )


def snapshot_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of a snapshot's distinct digests; a bucket is bounded by ``BUCKET_KEYS``."""

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, table = build_filter(_keys(frame["digest"]))
        return pd.DataFrame(
            {"bucket": [key[0]], "seed": [seed], "segment": [segment], "segments": [segments], "marks": [table.tobytes()]}
        )

    return (
        groups.select(_bucket(F.col("digest"), buckets).alias("bucket"), "digest")
        .groupBy("bucket")
        .applyInPandas(build, "bucket int, seed long, segment int, segments int, marks binary")
    )


def screened(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """``incoming`` groups with a flag: may be in the snapshot."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = left.drop(columns="bucket")
        maybe = np.zeros(len(left), dtype=bool)
        if len(left) and len(right):
            f = right.iloc[0]
            table = np.frombuffer(f["marks"], dtype=np.uint16)
            maybe = probe_filter(_keys(left["digest"]), int(f["seed"]), int(f["segment"]), int(f["segments"]), table)
        out["maybe"] = maybe
        return out

    return (
        incoming.withColumn("bucket", _bucket(F.col("digest"), buckets))
        .groupBy("bucket")
        .cogroup(filters.groupBy("bucket"))
        .applyInPandas(probe, "digest binary, n long, keep_id long, witness long, maybe boolean")
    )


def _same_bytes(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Digests of ``pairs`` (digest, old_witness, new_witness) whose two texts are identical."""
    wanted = pairs.select("digest", F.explode(F.array("old_witness", "new_witness")).alias("witness")).distinct()
    wanted = kept(wanted, "byte-check")
    count = wanted.count()
    texts = docs.join(shrink(wanted, count), F.col("doc_id").eqNullSafe(F.col("witness")))
    normal = texts.select("digest", ascii_lower(F.col("text")).alias("normal"))
    # A witness id that is repeated over other texts brings those along: keep those with the digest.
    normal = normal.where(F.sha2(F.col("normal").cast("binary"), 256) == F.lower(F.hex("digest")))
    return (
        normal.groupBy("digest")
        .agg(F.min("normal").alias("least"), F.max("normal").alias("most"))
        .where(F.col("least") == F.col("most"))
        .select("digest")
    )


def exact_groups(snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per document of both inputs: doc_id, keep_id, group_size, kept, text_sha256.

    An empty input on either side is fine; the other is then grouped alone.
    """
    rows = kept(
        digest_rows(snapshot).withColumn("fresh", F.lit(False)).unionByName(digest_rows(incoming).withColumn("fresh", F.lit(True))),
        "digests",
    )
    old = kept(_groups(rows.where(~F.col("fresh"))), "snapshot")
    new = _groups(rows.where("fresh"))
    buckets = max(1, -(-old.count() // BUCKET_KEYS))
    filters = kept(snapshot_filters(old, buckets), "filters")
    new = kept(screened(new, filters, buckets), "screened")
    pairs = (
        new.where("maybe")
        .select("digest", F.col("witness").alias("new_witness"))
        .join(old.select("digest", F.col("witness").alias("old_witness")), "digest")
    )
    docs = documents(snapshot).unionByName(documents(incoming))
    known = kept(_same_bytes(docs, pairs), "confirmed").withColumn("known", F.lit(True))
    # Where the bytes agree, both sides are one group; else the batch's group stands alone.
    joined = new.drop("maybe").join(known, "digest", "left").withColumn("fresh", F.col("known").isNull()).drop("known")
    groups = (
        old.withColumn("fresh", F.lit(False))
        .unionByName(joined)
        .groupBy("digest", "fresh")
        .agg(F.sum("n").alias("group_size"), F.max("keep_id").alias("keep_id"))
    )
    # Roots by (digest, side of the row): a confirmed digest of the batch belongs to the snapshot's group.
    roots = kept(groups, "groups")
    sides = roots.select("digest", "fresh").where("fresh").withColumn("own", F.lit(True))
    copies = rows.groupBy("digest", "fresh", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    placed = (
        copies.join(sides, ["digest", "fresh"], "left")
        .withColumn("side", F.coalesce("own", F.lit(False)))
        .select("digest", "doc_id", "n", "side")
        .groupBy("digest", "doc_id", "side")
        .agg(F.sum("n").alias("n"))
        .join(roots.withColumnRenamed("fresh", "side"), ["digest", "side"])
    )
    return placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("stays"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("stays") & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A snapshot and a batch, by a hash of doc_id (rows without one are in the batch)."""
    side = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)), F.lit(1))
    plain = documents(docs)
    return plain.where(F.col("doc_id").isNotNull() & (side == 0)), plain.where(F.col("doc_id").isNull() | (side == 1))


def dedup(docs: DataFrame) -> DataFrame:
    """``exact_groups`` with one half of the table as snapshot and the other as batch."""
    return exact_groups(*halves(docs))


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = kept(dedup(docs), "decided")
    key = ["doc_id", "__tm_sha"]
    stays = decided.groupBy("doc_id", F.col("text_sha256").alias("__tm_sha")).agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")
    )
    sha = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    rows = docs.withColumn("__tm_sha", sha)
    repeated = kept(stays.where("stays AND n > 1").select(*key), "repeated")
    rest = without(rows, stays.where("NOT stays OR n > 1").select(*key))
    once = only(rows, repeated).dropDuplicates(key)
    return rest.unionByName(once).drop("__tm_sha").select(*docs.columns)
