"""Every change of a batch as a version: runs of equal versioned columns, chained by date.

The changes of a key, in order of ``ds`` and the feed's order columns, open a version where a versioned
column differs from the change before, or where the key had none open; a version ends with the next change
that differs or deletes. Changes in between only overwrite the other columns. With ``null_safe``,
``honor_deletes`` and ``reopen`` what a change does depends on the change before it alone, so that
neighbours in a window tell all of it, and one batch of all changes equals a batch per change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import BOOKKEEPING, JOIN_KEY, KEY_BUCKET, SCD_COLUMNS, MergeRules
from tidemark.functions.keys import ACTIVE, any_changed, columns_except, delete_event
from tidemark.operators.merge import CLAUSE, CLOSED_CHANGED, CLOSED_DELETED, INSERTED, ORIGIN, OVERWRITTEN, UNTOUCHED
from tidemark.operators.sizing import broadcast_if
from tidemark.operators.staging import NEW, bucket_of

# Marks the active version that the table held before the batch; it precedes all changes.
_BASE = "_tl_base"
_BEFORE, _AFTER, _OWN = "_tl_before", "_tl_after", "_tl_own"
_CLOSE = "_tl_close"


def change_order(columns: Sequence[str], order_cols: Sequence[str], schema: T.StructType) -> list[str]:
    """Columns that order the changes of a key; those beyond ``order_cols`` break ties, as in ``latest_per_key``."""
    leading = ["ds", *order_cols]
    orderable = {f.name for f in schema.fields if "map<" not in f.dataType.simpleString()}
    return leading + [c for c in columns_except(columns, [*leading, JOIN_KEY]) if c in orderable]


def beside(rows: DataFrame, order: Sequence[Column], value: str, name: str, step: int, by_day: bool) -> DataFrame:
    """Adds ``name``: ``value`` of the row before (-1) or after (1) of the same key, null where there is none.

    ``by_day``: a key's rows are sorted day by day, and only the first and last row of every day over the
    whole key, so that a key with very many changes is spread over its days.
    """
    move = F.lag if step < 0 else F.lead
    whole = Window.partitionBy(JOIN_KEY).orderBy(*order)
    if not by_day:
        return rows.withColumn(name, move(value).over(whole))
    daily = Window.partitionBy(JOIN_KEY, "ds").orderBy(*order)
    first, last = F.lag(F.lit(1)).over(daily).isNull(), F.lead(F.lit(1)).over(daily).isNull()
    marked = rows.withColumns({name: move(value).over(daily), "_tl_first": first, "_tl_last": last})
    edge = F.col("_tl_first") | F.col("_tl_last")
    outer = F.col("_tl_first" if step < 0 else "_tl_last")
    edges = marked.where(edge).withColumn(name, F.when(outer, move(value).over(whole)).otherwise(F.col(name)))
    return edges.unionByName(marked.where(~edge)).drop("_tl_first", "_tl_last")


def fold(
    changes: DataFrame,
    base: DataFrame,
    scd_cols: Sequence[str],
    upd_cols: Sequence[str],
    order_cols: Sequence[str],
    by_day: bool = False,
) -> DataFrame:
    """The changes that open a version, and ``base``, next to the change that ends it (``_tl_close``).

    ``base``: key and versioned columns of the versions open before. ``_tl_close`` has ``ds``, ``op_type``,
    ``last`` (no change of the key follows), ``kept`` (it follows the base directly) and ``upd``, the
    overwritten columns as they were before it.
    """
    order = change_order(changes.columns, order_cols, changes.schema)
    started = changes.withColumn(_BASE, F.lit(False)).unionByName(
        base.withColumn(_BASE, F.lit(True)), allowMissingColumns=True
    )
    sort = [F.desc(_BASE), *[F.asc_nulls_first(c) for c in order]]
    deletes = F.coalesce(F.expr(delete_event()), F.lit(False))
    packed = lambda names: F.struct(*[F.col(c) for c in names]) if names else F.struct(F.lit(0).alias("_none"))
    own = F.struct(F.col(_BASE).alias("base"), deletes.alias("deletes"), packed(scd_cols).alias("scd"), packed(upd_cols).alias("upd"))
    rows = started.withColumn(_OWN, own)
    rows = beside(rows, sort, _OWN, _BEFORE, -1, by_day)
    rows = beside(rows, sort, _OWN, _AFTER, 1, by_day)
    was_open = F.col(_BEFORE).isNotNull() & (F.col(f"{_BEFORE}.base") | ~F.col(f"{_BEFORE}.deletes"))
    differs = ~F.col(f"{_BEFORE}.scd").eqNullSafe(F.col(f"{_OWN}.scd"))
    change = ~F.col(_BASE)
    opens = change & ~deletes & (~was_open | differs)
    closes = change & was_open & (deletes | differs)
    closing = F.struct(
        F.col("ds"),
        F.col("op_type"),
        F.col(_AFTER).isNull().alias("last"),
        F.col(f"{_BEFORE}.base").alias("kept"),
        F.col(f"{_BEFORE}.upd").alias("upd"),
    )
    # Compacted: what lies between two edges of versions is no longer needed.
    edges = rows.withColumns({"_tl_opens": opens, "_tl_closes": closes}).where(F.col("_tl_opens") | F.col("_tl_closes") | F.col(_BASE))
    edges = edges.withColumn("_tl_edge", closing).drop(_OWN, _BEFORE, _AFTER)
    # The edge after the one that opens a version is the one that closes it.
    edges = beside(edges, sort, "_tl_edge", _CLOSE, 1, by_day)
    return edges.where(F.col("_tl_opens") | F.col(_BASE)).drop("_tl_opens", "_tl_closes", "_tl_edge")


def _upd_of_closed(upd_cols: Sequence[str], rules: MergeRules, newest: str) -> dict[str, str]:
    """The overwritten columns of a version closed by the batch, as SQL text.

    The change that closes it does not overwrite it, later ones do, unless ``active_only_overwrite``.
    """
    later = f"NOT {_CLOSE}.last" if not rules.active_only_overwrite else "false"
    return {c: f"CASE WHEN {later} THEN `{newest}{c}` ELSE {_CLOSE}.upd.`{c}` END" for c in upd_cols}


def new_versions(
    folded: DataFrame,
    newest: DataFrame,
    upd_cols: Sequence[str],
    target_schema: T.StructType,
    rules: MergeRules,
    small: bool = False,
    key_buckets: int = 0,
) -> DataFrame:
    """Rows of the table for the versions that the changes opened, closed where a later change did so."""
    last = newest.select(F.col(JOIN_KEY).alias("_tl_key"), *[F.col(c).alias(NEW + c) for c in upd_cols])
    opened = folded.where(f"NOT {_BASE}").join(broadcast_if(last, small), F.col(JOIN_KEY) == F.col("_tl_key"))
    closed = _upd_of_closed(upd_cols, rules, NEW)
    values = {f.name: f"`{f.name}`" for f in target_schema.fields if f.name not in (*BOOKKEEPING, *SCD_COLUMNS)}
    values |= {c: f"CASE WHEN {_CLOSE} IS NULL THEN `{NEW}{c}` ELSE {closed[c]} END" for c in upd_cols}
    values |= {
        "ActiveIndicator": f"{_CLOSE} IS NULL",
        "EffectiveDate": "ds",
        "EndDate": f"{_CLOSE}.ds",
        "Action": f"CASE WHEN {_CLOSE} IS NULL THEN op_type ELSE {_CLOSE}.op_type END",
    }
    if key_buckets:
        values[KEY_BUCKET] = bucket_of(f"`{JOIN_KEY}`", key_buckets)
    return opened.selectExpr(
        *[f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in target_schema.fields],
        f"{INSERTED} AS {CLAUSE}",
    )


def changed_versions(
    matched: DataFrame,
    folded: DataFrame,
    columns: Sequence[tuple[str, str]],
    upd_cols: Sequence[str],
    rules: MergeRules,
    origin: str | None = None,
    small: bool = False,
) -> DataFrame:
    """The versions that the table held, after the batch, tagged with what happened to them.

    ``matched``: versions next to the newest change of their key (``_s_`` columns).
    """
    ends = folded.where(f"{_BASE} AND {_CLOSE} IS NOT NULL").select(F.col(JOIN_KEY).alias("_tl_key"), _CLOSE)
    rows = matched.join(broadcast_if(ends, small), (F.col(JOIN_KEY) == F.col("_tl_key")) & F.expr(ACTIVE), "left")
    only = f"{ACTIVE} AND " if rules.active_only_overwrite else ""
    clause = (
        f"CASE WHEN {_CLOSE} IS NOT NULL THEN IF({delete_event(_CLOSE + '.op_type')} IS TRUE, {CLOSED_DELETED}, {CLOSED_CHANGED}) "
        f"WHEN {only}{any_changed(upd_cols, '', NEW, null_safe=True)} THEN {OVERWRITTEN} ELSE {UNTOUCHED} END"
    )
    closing = f"{CLAUSE} IN ({CLOSED_CHANGED}, {CLOSED_DELETED})"
    closed = _upd_of_closed(upd_cols, rules, NEW)
    values = {
        # Directly after the base nothing of the batch had overwritten it yet.
        c: f"CASE WHEN {CLAUSE} = {OVERWRITTEN} THEN `{NEW}{c}` "
        f"WHEN {closing} AND NOT ({_CLOSE}.kept AND ({_CLOSE}.last OR {str(rules.active_only_overwrite).lower()})) THEN {closed[c]} ELSE `{c}` END"
        for c in upd_cols
    }
    values["ActiveIndicator"] = f"CASE WHEN {closing} THEN false ELSE ActiveIndicator END"
    values["EndDate"] = f"CASE WHEN {closing} THEN {_CLOSE}.ds ELSE EndDate END"
    values["Action"] = f"CASE WHEN {closing} THEN {_CLOSE}.op_type ELSE Action END"
    before = [f"`{origin}` AS {ORIGIN}"] if origin else []
    return rows.withColumn(CLAUSE, F.expr(clause)).selectExpr(
        *[f"CAST({values.get(name, f'`{name}`')} AS {kind}) AS `{name}`" for name, kind in columns], CLAUSE, *before
    )


def open_versions(matched: DataFrame, scd_cols: Sequence[str]) -> DataFrame:
    """Key and versioned columns of the active ones among the matched versions."""
    return matched.where(ACTIVE).select(JOIN_KEY, *scd_cols)


def most_per_key(changes: DataFrame) -> int:
    counted = changes.groupBy(JOIN_KEY).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
