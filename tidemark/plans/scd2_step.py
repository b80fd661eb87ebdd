"""One micro-batch into a versioned (SCD type 2) table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.config import JOIN_KEY, KEY_BUCKET, CdcFeed
from tidemark.functions.keys import ACTIVE, key_first, overwrite_columns
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import (
    CLAUSE,
    CLOSED_CHANGED,
    CLOSED_DELETED,
    INSERTED,
    ORIGIN,
    OVERWRITTEN,
    REMOVED,
    UNTOUCHED,
    apply_clauses,
    inserted_rows,
    merge,
)
from tidemark.operators.sizing import measure
from tidemark.operators.skew import hot_keys, versions_per_key
from tidemark.operators.staging import (
    changed_among,
    match_versions,
    point_filter,
    reopened_among,
    stage,
    staged_updates,
    versions_of,
    versions_of_other_keys,
)
from tidemark.operators.timeline import changed_versions, fold, most_per_key, new_versions, open_versions
from tidemark.plans.late_changes import of_keys, place_by_time, replace_versions
from tidemark.plans.merge_into import merge_into, supports_merge
from tidemark.plans.partitions import (
    Delivery,
    Move,
    distinct_places,
    finish_pending,
    in_places,
    mark_applied,
    replace_partitions,
    was_applied,
)
from tidemark.session import remove_dir, run_dir, run_id
from tidemark.sources.tables import CLOSED_FILES, OPEN_FILES, TableRef, not_in_files


# Writer settings for a Bloom filter of the keys, as small as the row group allows.
KEY_FILTERS = {f"parquet.bloom.filter.enabled#{JOIN_KEY}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

# By the first name of files: the rows they hold, and the files that hold none of them.
ALL_FILES = {"part": ("true", None)}
SPLIT_FILES = {
    OPEN_FILES: (ACTIVE, CLOSED_FILES),
    CLOSED_FILES: (f"NOT ({ACTIVE}) OR ActiveIndicator IS NULL", OPEN_FILES),
}


@dataclass(frozen=True)
class Scd2Report:
    keys: int = 0
    inserted: int = 0
    closed: int = 0
    overwritten: int = 0
    partitions: int = 0
    rewritten: int = 0  # rows written, those of other keys in the same partitions included
    skipped: bool = False


def newest_changes(batch: DataFrame, feed: CdcFeed) -> DataFrame:
    newest = latest_per_key(batch, feed.order_cols)
    return key_first(newest.drop(*feed.transport))


def column_sets(newest: DataFrame, feed: CdcFeed) -> tuple[list[str], list[str]]:
    """(versioned columns, columns overwritten in place)."""
    return list(feed.scd_cols), overwrite_columns(newest.columns, feed.scd_cols, feed.key_cols)


def scd2_step(target: DataFrame, batch: DataFrame, feed: CdcFeed) -> DataFrame:
    """The table after one batch, as a plain DataFrame (no storage involved)."""
    newest = newest_changes(batch, feed)
    scd, upd = column_sets(newest, feed)
    if feed.rules.by_time:
        raise ValueError("by_time needs the table of all changes")
    if feed.rules.every_change:
        matched = match_versions(target, newest)
        folded = fold(batch, open_versions(matched, scd), scd, upd, feed.order_cols)
        updated = changed_versions(matched, folded, target.dtypes, upd, feed.rules)
        inserts = new_versions(folded, newest, upd, target.schema, feed.rules)
        return versions_of_other_keys(newest, target).unionByName(updated.unionByName(inserts).drop(CLAUSE))
    staged = staged_updates(newest, target, scd, feed.rules)
    return merge(target, staged, scd, upd, feed.rules)


def apply_scd2_batch(
    spark: SparkSession,
    batch: DataFrame,
    table: TableRef,
    feed: CdcFeed,
    delivery: Delivery | None = None,
    changes_table: TableRef | None = None,
) -> Scd2Report:
    """Merge a batch, rewriting only the partitions in which a row changes.

    1. newest change per key, measured;
    2. key and partition column of the table: which partitions hold these keys;
    3. the versions of these keys, from those partitions only, next to the
       newest change: every clause is decided on this one join;
    4. which partitions change or receive rows;
    5. rewrite those: rows of other keys unchanged, merged versions, new versions;
       then swap them in.

    With a batch small enough to broadcast the table is never shuffled. With ``every_change`` step 1 keeps
    all changes as well, and step 3 folds them; with ``by_time`` ``changes_table`` has those of earlier
    batches.
    """
    stored = finish_pending(spark, table)
    delivery = delivery if feed.batch_ledger else None
    if was_applied(stored, delivery):
        return Scd2Report(skipped=True)
    if feed.rules.every_change and supports_merge(table):
        raise ValueError(f"every_change is not for {table.format} tables")
    if feed.rules.by_time and changes_table is None:
        raise ValueError("by_time needs the table of all changes")

    work = run_dir(spark, "late-changes")
    late, few = None, False
    if feed.rules.by_time:
        batch, late, few = place_by_time(spark, batch, changes_table, feed, work)
    newest = newest_changes(batch, feed).persist()
    kept = [newest]
    try:
        size = measure(newest)
        small = size.within(feed.broadcast_bytes)
        scd, upd = column_sets(newest, feed)
        if not scd and not upd:
            mark_applied(spark, table, delivery)
            return Scd2Report(keys=size.rows)
        target = searched = spark.table(table.sql_name)
        if small and (wanted := point_filter(newest, size.rows)) is not None:
            searched = target.where(wanted)

        if supports_merge(table):
            staged = staged_updates(newest, target, scd, feed.rules, small)
            merge_into(staged, table, scd, upd, feed.rules)
            mark_applied(spark, table, delivery)
            return Scd2Report(keys=size.rows)

        part, parts_of = table.partition_col, table.partition_cols
        located = searched.select(JOIN_KEY, *parts_of)
        hot = None
        if small:
            touched = distinct_places(versions_of(newest, located, small), parts_of)
        else:
            # One narrow pass: versions per key of the batch and partition.
            held = versions_per_key(newest, located, *parts_of).persist()
            kept.append(held)
            touched = distinct_places(held, parts_of)
            hot = hot_keys(held, feed.hot_versions, feed.broadcast_bytes)
            if hot is not None:
                kept.append(hot)
        matched = match_versions(
            searched.where(in_places(parts_of, touched)), newest, "inner", small, hot
        ).persist()
        kept.append(matched)
        if feed.rules.every_change:
            base = open_versions(matched, scd)
            if late is not None:
                base = of_keys(base, late, few, "left_anti")
            folded = fold(batch, base, scd, upd, feed.order_cols, most_per_key(batch) >= feed.hot_versions).persist()
            inserts = new_versions(folded, newest, upd, target.schema, feed.rules, small, table.key_buckets)
            updated = changed_versions(matched, folded, target.dtypes, upd, feed.rules, part, small)
            kept.append(folded)
            if late is not None:
                updated, inserts = replace_versions(updated, inserts.persist(), matched, late, few, part)
                updated = updated.persist()
                kept.append(updated)
        else:
            again = changed_among(matched, newest.columns, scd, feed.rules) if scd else None
            if feed.rules.reopen:
                closed = reopened_among(newest, matched, feed.rules, small)
                again = closed if again is None else again.unionByName(closed)
            inserts = inserted_rows(
                stage(newest, again), matched, target.schema, feed.rules, small, table.key_buckets
            )
            updated = apply_clauses(matched, target.dtypes, scd, upd, feed.rules, origin=part)
        inserts = inserts.persist()
        kept.append(inserts)

        # Two actions on purpose: the first one fills the cache of ``matched``, which
        # the second reads in several stages that would otherwise compute it side by side.
        bucket = KEY_BUCKET if table.key_buckets else None
        effects = _changes(updated, part, bucket) + _arrivals(inserts, part, bucket)
        # Value(s) of the partition, and the same as text.
        parts = {
            (r["part"], r["bucket"])[: len(parts_of)]: (r["text"], str(r["bucket"]) if bucket else None)
            for r in effects
        }
        report = _report(size.rows, effects, len(parts))
        if not parts:
            mark_applied(spark, table, delivery)
            return report

        # Rows of other keys are carried over; the merged versions replace the rest.
        affected = in_places(parts_of, parts)
        merged = updated.where(f"{CLAUSE} <> {REMOVED}").drop(ORIGIN).where(affected).unionByName(inserts).drop(CLAUSE)
        folder = f"{table.location}/_versions/{run_id()}"
        written = 0
        for files, (kind, others) in (SPLIT_FILES if table.split_active else ALL_FILES).items():
            stays = target.where(affected)
            if others:
                stays = stays.where(kind).where(not_in_files(others))
            carried = versions_of_other_keys(newest, stays, small, hot)
            if not small:
                # That join hashes rows by key, i.e. every task would hold every partition.
                carried = carried.hint("rebalance", *parts_of)
            rows = carried.unionByName(merged.where(kind).hint("rebalance", *parts_of))
            written += _write(rows, folder, files, parts_of)
        report = replace(report, rewritten=written)

        # Only rows that moved between partitions can leave one empty. The folders are read with
        # the table's own types, whatever the session infers.
        filled = set(parts.values())
        if any(not r["lands"] for r in effects):
            files = spark.read.schema(target.schema).parquet(folder)
            texts = [F.col(c).cast("string").alias(c) for c in parts_of]
            filled = {(*place, None)[:2] for place in distinct_places(files.select(*texts), parts_of)}
        moves = [Move(text[0], text not in filled, text[1]) for text in parts.values()]
        replace_partitions(spark, table, folder, moves, delivery)
        return report
    finally:
        for df in kept:
            df.unpersist()
        if feed.rules.by_time:
            remove_dir(spark, work)


def _write(rows: DataFrame, folder: str, files: str, parts_of: list[str]) -> int:
    """Add rows to a folder of partitions, in files of the given first name; returns their number."""
    written = Observation()
    rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
    # In the order of the keys, which takes no more than the writer's own sort by partition.
    rows = rows.sortWithinPartitions(*parts_of, JOIN_KEY)
    named = {"mapreduce.output.basename": files}
    rows.write.mode("append").options(**KEY_FILTERS, **named).partitionBy(*parts_of).parquet(folder)
    return written.get["n"]


def _report(keys: int, effects: list[Row], partitions: int) -> Scd2Report:
    counts = dict.fromkeys((INSERTED, CLOSED_CHANGED, CLOSED_DELETED, OVERWRITTEN), 0)
    for r in effects:
        if r["lands"]:
            counts[r[CLAUSE]] += r["n"]
    return Scd2Report(
        keys=keys,
        inserted=counts[INSERTED],
        closed=counts[CLOSED_CHANGED] + counts[CLOSED_DELETED],
        overwritten=counts[OVERWRITTEN],
        partitions=partitions,
    )


def _changes(updated: DataFrame, part: str, bucket: str | None) -> list[Row]:
    """Changed rows per clause and partition: at most a few rows per table partition.

    A row that moves counts in both partitions, and ``lands`` in the second only; a removed one in none.
    """
    there = f"named_struct('part', `{part}`, 'lands', true)"
    gone = f"named_struct('part', {ORIGIN}, 'lands', false)"
    kept = bucket or "CAST(NULL AS INT)"
    places = f"inline(CASE WHEN {CLAUSE} = {REMOVED} THEN array({gone}) WHEN {ORIGIN} <=> `{part}` THEN array({there}) ELSE array({gone}, {there}) END)"
    changed = updated.where(f"{CLAUSE} <> {UNTOUCHED}")
    return _counted(changed.selectExpr(CLAUSE, f"{kept} AS bucket", places))


def _arrivals(inserts: DataFrame, part: str, bucket: str | None) -> list[Row]:
    kept = bucket or "CAST(NULL AS INT)"
    return _counted(inserts.selectExpr(CLAUSE, f"{kept} AS bucket", f"`{part}` AS part", "true AS lands"))


def _counted(rows: DataFrame) -> list[Row]:
    return (
        rows.groupBy(CLAUSE, "part", "bucket", "lands")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("text", F.col("part").cast("string"))
        .collect()
    )
