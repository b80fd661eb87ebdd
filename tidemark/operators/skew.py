"""Key joins that survive a key holding a large share of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_BROADCAST_BYTES, JOIN_KEY
from tidemark.operators.sizing import measure

_HOT_KEY, _COPIES, _SALT, _RIGHT_SALT = "_hot_key", "_copies", "_salt", "_r_salt"
_VERSIONS = "_versions_held"


def versions_per_key(newest: DataFrame, located: DataFrame, *parts: str) -> DataFrame:
    """Versions that the table holds of each key of the batch, per partition.

    Counted below the shuffle, so that a key with very many versions travels once per map task.
    """
    counted = located.groupBy(JOIN_KEY, *parts).agg(F.count(F.lit(1)).alias(_VERSIONS))
    keys = newest.select(F.col(JOIN_KEY).alias("_n_key"))
    return counted.join(keys, F.col(JOIN_KEY) == F.col("_n_key"), "left_semi")


def hot_keys(
    held: DataFrame, hot_versions: int, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame | None:
    """Keys with at least ``hot_versions`` versions and how many pieces each is cut into.

    ``held`` comes from :func:`versions_per_key`. The list is broadcast later; should it be
    bigger than ``broadcast_bytes`` (64 MB at least), the floor doubles until it fits.
    """
    per_key = held.groupBy(F.col(JOIN_KEY).alias(_HOT_KEY)).agg(F.sum(_VERSIONS).alias("n"))
    limit = max(broadcast_bytes, DEFAULT_BROADCAST_BYTES)
    floor = hot_versions
    while True:
        hot = (
            per_key.where(F.col("n") >= floor)
            .select(_HOT_KEY, F.ceil(F.col("n") / floor).cast("int").alias(_COPIES))
            .persist()
        )
        size = measure(hot)
        if size.rows and size.within(limit):
            return hot
        hot.unpersist()
        if not size.rows:
            return None
        floor *= 2


def join_on_key(
    target: DataFrame,
    right: DataFrame,
    right_key: str,
    how: str,
    small: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join table rows with at most one ``right`` row per key.

    ``small``: ``right`` was measured and is broadcast; the table is scanned, not
    shuffled. Otherwise both sides are shuffled, and the rows of a key listed in
    ``hot`` are spread over several tasks, each of which gets a copy of its
    ``right`` row. The salt is a hash of the row, so a lost task re-computes the
    same placement.
    """
    same_key = F.col(JOIN_KEY) == F.col(right_key)
    if small:
        return target.join(F.broadcast(right), same_key, how)
    if hot is None:
        return target.join(right, same_key, how)
    listed = F.broadcast(hot)
    salted = target.join(listed, F.col(JOIN_KEY) == F.col(_HOT_KEY), "left").select(
        *target.columns,
        F.expr(f"coalesce(pmod(xxhash64({_quoted(target.columns)}), {_COPIES}), 0)").alias(_SALT),
    )
    copied = right.join(listed, F.col(right_key) == F.col(_HOT_KEY), "left").select(
        *right.columns,
        F.expr(f"explode(sequence(0, coalesce({_COPIES}, 1) - 1))").alias(_RIGHT_SALT),
    )
    same_piece = F.col(_SALT) == F.col(_RIGHT_SALT)
    return salted.join(copied, same_key & same_piece, how).drop(_SALT, _RIGHT_SALT)


def _quoted(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)
