"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources in code-point order (null last) get the weights in turn. Their targets share all words by
weight; a target stops at ``MAX_REPEATS`` times what its source has, and the excess is shared anew by
weight until none is above. The targets are met in blocks of ``BLOCK`` words: blocks go to sources by
the highest quotients target / (2 q + 1), and a source's blocks to its shards likewise, so that every
shard knows its quota before anything is drawn. A shard takes whole passes over its documents and then
a seeded choice of its blocks; a document gets the words of it that lie in chosen blocks.

Null or empty texts have size 0 and take 0. Repeated rows are separate documents, dealt to shards each. An empty table gives
no rows. A shard holds about ``SHARD_WORDS`` words and at most about ``SHARD_ROWS`` rows, so a source of
any size is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import kept
from tidemark.llm.textops import text_chunks, words_of

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 64
SHARD_WORDS = 1 << 20
SHARD_ROWS = 1 << 14
SEED = 17


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.zeros(batch.num_rows, dtype=np.int64)
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            _, _, row = words_of(data, offsets)
            counts[lo:hi] = np.bincount(row, minlength=hi - lo)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"), pa.array(counts)], ["doc_id", "source", "size"]
        )


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, size."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    return plain.mapInArrow(_sizes, "doc_id long, source string, size long")


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Adds ``target`` to (source, source_size); one row per source.

    Filling up by water level: ordered by cap per weight, the first k sources are at their cap when the
    level left by them is above the cap per weight of each.
    """
    all_rows = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_repeats))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    capped = ranked.withColumn("level", level).withColumn("full", F.col("cap") / F.col("weight") < F.col("level"))
    # The level that holds is that of the first source not at its cap; with all at it there is no excess left.
    final = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(all_rows)["level"]
    return capped.select(
        "source",
        "source_size",
        F.when(F.col("full") | final.isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * final)).alias("target"),
    )


def apportion(shares: DataFrame, group: list[str], share: str, seats: str, tie: list[str], out: str) -> DataFrame:
    """Sainte-Lague: column ``out`` gives each row its whole number of the group's ``seats``.

    With n rows and N seats the result lies between share / total * (N - n/2) and (N + n/2), both
    rounded, so that only about 2 n quotients have to be ranked; the seats below are certain. Ties go by
    ``tie``. A group without shares gets nothing.

    The bounds are kept, as they are needed twice: a plan that held them twice would grow with every step before.
    """
    w = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(w), F.sum(share).over(w)
    ratio = F.when(F.col("__total") > 0, F.col(share) / F.col("__total")).otherwise(0.0)
    bounded = (
        shares.withColumn("__n", n)
        .withColumn("__total", total)
        .withColumn("__low", F.greatest(F.lit(0), F.floor(ratio * (F.col(seats) - F.col("__n") / 2) - 0.5)))
        .withColumn("__high", F.when(F.col("__total") > 0, F.ceil(ratio * (F.col(seats) + F.col("__n") / 2) + 0.5)).otherwise(0))
        .withColumn("__open", F.col(seats) - F.sum("__low").over(w))
    )
    bounded = kept(bounded, "bounds")
    quotients = bounded.where("__high > __low").withColumn("__q", F.explode(F.sequence(F.col("__low"), F.col("__high") - 1)))
    best = Window.partitionBy(*group).orderBy((F.col(share) / (2 * F.col("__q") + 1)).desc(), *tie, "__q")
    keys = [*group, *[t for t in tie if t not in group]]
    won = (
        quotients.withColumn("__rank", F.row_number().over(best))
        .where(F.col("__rank") <= F.col("__open"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__won"))
    )
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    return bounded.alias("b").join(won.alias("w"), same, "left").select(
        *[F.col(f"b.{c}").alias(c) for c in shares.columns],
        (F.col("b.__low") + F.coalesce("w.__won", F.lit(0))).cast("long").alias(out),
    )


def _draw(seed: int, block: int, most: int):
    """For one shard: words taken per document."""

    def draw(key, frame: pd.DataFrame) -> pd.DataFrame:
        source_id, shard = int(key[0]), int(key[1])
        frame = frame.sort_values(["doc_id", "size"], na_position="last", kind="stable")
        rng = np.random.default_rng([seed, source_id, shard])
        frame = frame.iloc[rng.permutation(len(frame))]
        size = frame["size"].to_numpy(np.int64)
        held = int(size.sum())
        words = min(int(frame["quota"].iloc[0]) * block, most * held)
        passes = words // held if held else 0
        rest = words - passes * held
        taken = passes * size
        if rest:
            blocks = -(-held // block)
            width = np.full(blocks, block, dtype=np.int64)
            width[-1] = held - (blocks - 1) * block
            picked = rng.permutation(blocks)
            # Whole blocks in drawn order; the last one is cut to what is still missing.
            reach = np.cumsum(width[picked])
            used = np.minimum(width[picked], np.maximum(rest - (reach - width[picked]), 0))
            in_block = np.zeros(blocks, dtype=np.int64)
            in_block[picked] = used
            before = np.concatenate(([0], np.cumsum(in_block)))
            edge = np.concatenate(([0], np.cumsum(size)))
            at, off = np.divmod(edge, block)
            filled = before[np.minimum(at, blocks)] + np.minimum(off, in_block[np.minimum(at, blocks - 1)]) * (at < blocks)
            taken = taken + np.diff(filled)
        return pd.DataFrame(
            {
                "doc_id": frame["doc_id"],
                "size": size,
                "source_size": frame["source_size"],
                "target": frame["target"],
                "taken": taken,
            }
        )

    return draw


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    rows = kept(word_counts(docs), "sizes")
    # What is needed more than once is kept: short plans, and little of them on the driver at once.
    totals = kept(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")), "totals")
    targets = source_targets(totals.drop("source_rows"), weights, max_repeats)
    same_source = F.col("t.source").eqNullSafe(F.col("s.source"))
    sources = (
        totals.alias("s")
        .join(targets.alias("t"), same_source)
        .select("s.source", "s.source_size", "s.source_rows", "t.target")
        .withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int"))
        .withColumn("blocks", F.floor(F.sum("source_size").over(Window.partitionBy()) / block + 0.5))
        .withColumn("all", F.lit(0))
    )
    sources = apportion(sources, ["all"], "target", "blocks", ["source_id"], "source_quota")
    spread = F.ceil(F.greatest(F.col("source_size") / shard_words, F.col("source_rows") / shard_rows, F.lit(1)))
    sources = kept(sources.withColumn("shards", spread.cast("int")).drop("all", "blocks"), "sources")
    held = F.broadcast(sources) if sources.count() <= 1 << 16 else sources.hint("shuffle_hash")
    # Rows alike in id, source and size are numbered, so that those of one id, or without one, spread as well.
    alike = rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("k"))
    numbered = alike.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))).drop("k")
    placed = (
        numbered.alias("r")
        .join(held.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
        .select(
            "r.doc_id",
            "r.size",
            "s.source_id",
            F.pmod(F.xxhash64(F.coalesce("r.doc_id", F.lit(-1)), "r.size", "r.nth", F.lit(seed)), F.col("s.shards")).cast("int").alias("shard"),
            "s.source_size",
            "s.target",
            "s.source_quota",
        )
    )
    placed = kept(placed, "placed")
    shards = placed.groupBy("source_id", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(shards, ["source_id"], "shard_size", "source_quota", ["shard"], "quota")
    quotas = quotas.select("source_id", "shard", "quota")
    ready = placed.drop("source_quota").join(quotas, ["source_id", "shard"])
    return ready.groupBy("source_id", "shard").applyInPandas(
        _draw(seed, block, max_repeats), "doc_id long, size long, source_size long, target double, taken long"
    )
