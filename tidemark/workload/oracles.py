"""The same results as plain SQL over the test tables, for an independent engine.

The versioned tables are written as chains of common table expressions, one
layer per batch: newest rows, matched rows, re-inserts and unmatched rows.
"""

from __future__ import annotations

from collections.abc import Sequence

_TIER = "CASE WHEN value < 50 THEN 'low' WHEN value < 150 THEN 'mid' ELSE 'high' END"
_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END"
_BATCH = "CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END"


def _changes(nulls: bool = False, day: bool = False, later_type: bool = False) -> str:
    kind = f"CASE WHEN {_BATCH} > 1 THEN event_type END AS event_type" if later_type else "event_type"
    tier = f"nullif({_TIER}, 'mid')" if nulls else _TIER
    extra = (
        "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))::INTEGER AS day, "
        "CAST(ts AS DATE) AS \"day_PARTITION\", "
        if day
        else ""
    )
    return (
        f"e AS (SELECT CAST(user_id AS VARCHAR) AS \"JoinKey\", user_id, {tier} AS tier, "
        f"{kind}, {extra}{_OP} AS op_type, CAST(ts AS DATE) AS ds, event_id, "
        f"{_BATCH} AS batch_no FROM events)"
    )


def _chain(
    batches: Sequence[int] = (1, 2, 3),
    scd: Sequence[str] = ("tier",),
    upd: Sequence[str] = ("event_type",),
    nulls: bool = False,
    day: bool = False,
    null_safe: bool = False,
    honor_deletes: bool = False,
    reopen: bool = False,
    active_only: bool = False,
    later_type: bool = False,
) -> str:
    """CTE list ending in ``s<n>``, the table after the last batch."""
    payload = ["user_id", "tier", "event_type"] + (["day", '"day_PARTITION"'] if day else [])
    cols = ['"JoinKey"', *payload]
    differ = "IS DISTINCT FROM" if null_safe else "<>"

    def changed(columns: Sequence[str]) -> str:
        return "(" + " OR ".join(f"t.{c} {differ} n.{c}" for c in columns) + ")"

    ctes = [
        _changes(nulls, day, later_type),
        "s0 AS (SELECT "
        + ", ".join(cols)
        + ", TRUE AS \"ActiveIndicator\", ds AS \"EffectiveDate\", CAST(NULL AS DATE) AS \"EndDate\", "
        'op_type AS "Action" FROM e WHERE FALSE)',
    ]
    not_delete = " AND n.op_type <> 'd'" if honor_deletes else ""
    for i, batch in enumerate(batches, start=1):
        listed = ", ".join(map(str, batch if isinstance(batch, tuple) else (batch,)))
        prev = f"s{i - 1}"
        ctes.append(
            f"n{i} AS (SELECT * FROM e WHERE batch_no IN ({listed}) QUALIFY row_number() OVER "
            '(PARTITION BY "JoinKey" ORDER BY ds DESC NULLS LAST, event_id DESC) = 1)'
        )
        whens = []
        if scd:
            whens.append(f"WHEN t.\"ActiveIndicator\" AND {changed(scd)} THEN 1")
        whens.append("WHEN t.\"ActiveIndicator\" AND n.op_type = 'd' THEN 2")
        if upd:
            only = 't."ActiveIndicator" AND ' if active_only else ""
            whens.append(f"WHEN {only}{changed(upd)} THEN 3")
        ctes.append(
            f"m{i} AS (SELECT t.*, n.ds AS n_ds, n.op_type AS n_op"
            + "".join(f", n.{c} AS n_{c.strip(chr(34))}" for c in upd)
            + ", CASE WHEN n.\"JoinKey\" IS NULL THEN 0 "
            + " ".join(whens)
            + f' ELSE 0 END AS clause FROM {prev} t LEFT JOIN n{i} n ON t."JoinKey" = n."JoinKey")'
        )
        kept = ", ".join(
            f"CASE WHEN clause = 3 THEN n_{c.strip(chr(34))} ELSE {c} END AS {c}" if c in upd else c
            for c in cols
        )
        again = []
        if scd:
            again.append(
                f'SELECT n.* FROM n{i} n JOIN {prev} t ON t."JoinKey" = n."JoinKey" '
                f'WHERE t."ActiveIndicator" AND {changed(scd)}{not_delete}'
            )
        if reopen:
            again.append(
                f'SELECT n.* FROM n{i} n WHERE EXISTS (SELECT 1 FROM {prev} t WHERE '
                f't."JoinKey" = n."JoinKey") AND NOT EXISTS (SELECT 1 FROM {prev} t WHERE '
                f't."JoinKey" = n."JoinKey" AND t."ActiveIndicator"){not_delete}'
            )
        again.append(
            f'SELECT n.* FROM n{i} n WHERE NOT EXISTS (SELECT 1 FROM {prev} t WHERE '
            f't."JoinKey" = n."JoinKey"){not_delete}'
        )
        ctes.append(f"i{i} AS (" + " UNION ALL ".join(again) + ")")
        ctes.append(
            f"s{i} AS (SELECT {kept}, "
            'CASE WHEN clause IN (1, 2) THEN FALSE ELSE "ActiveIndicator" END AS "ActiveIndicator", '
            '"EffectiveDate", CASE WHEN clause IN (1, 2) THEN n_ds ELSE "EndDate" END AS "EndDate", '
            'CASE WHEN clause IN (1, 2) THEN n_op ELSE "Action" END AS "Action" '
            f"FROM m{i} UNION ALL SELECT {', '.join(cols)}, TRUE, ds, NULL, op_type FROM i{i})"
        )
    return "WITH " + ", ".join(ctes)


def _table(**settings) -> str:
    last = len(settings.get("batches", (1, 2, 3)))
    return f"{_chain(**settings)} SELECT * FROM s{last}"


def _timeline(nulls: bool = False) -> str:
    """All changes of every key in order of time, folded at once."""
    window = '(PARTITION BY "JoinKey" ORDER BY ds NULLS FIRST, event_id)'
    differs = "tier IS DISTINCT FROM p_tier"
    return (
        f"WITH {_changes(nulls)}, o AS (SELECT *, lag(op_type) OVER k AS p_op, lag(tier) OVER k AS p_tier, "
        "lag(event_type) OVER k AS p_type, lead(event_id) OVER k IS NULL AS final, "
        'last(event_type) OVER (PARTITION BY "JoinKey" ORDER BY ds NULLS FIRST, event_id '
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l_type FROM e WINDOW k AS {window}), "
        "g AS (SELECT *, coalesce(p_op <> 'd', FALSE) AS was_open FROM o), "
        f"h AS (SELECT *, op_type <> 'd' AND (NOT was_open OR {differs}) AS opens, "
        f"was_open AND (op_type = 'd' OR {differs}) AS closes FROM g), "
        "v AS (SELECT *, lead(ds) OVER k AS c_ds, lead(op_type) OVER k AS c_op, lead(final) OVER k AS c_final, "
        f"lead(p_type) OVER k AS c_type FROM h WHERE opens OR closes WINDOW k AS {window}) "
        'SELECT "JoinKey", user_id, tier, CASE WHEN c_final THEN c_type ELSE l_type END AS event_type, '
        'c_op IS NULL AS "ActiveIndicator", ds AS "EffectiveDate", c_ds AS "EndDate", '
        'coalesce(c_op, op_type) AS "Action" FROM v WHERE opens'
    )


_NEW_COLS = '"JoinKey", user_id, tier, event_type, op_type, ds'
_CHANGED = (
    'SELECT {cols} FROM n3 n JOIN s2 t ON t."JoinKey" = n."JoinKey" '
    'WHERE t."ActiveIndicator" AND t.tier <> n.tier'
)


def _changed_keys(merge_key: str = "") -> str:
    cols = merge_key + ", ".join(f"n.{c.strip()}" for c in _NEW_COLS.split(","))
    return _CHANGED.format(cols=cols)


def _history(steps: Sequence[Sequence[int]], nulls: bool = False, null_safe: bool = False) -> str:
    cols = ("user_id", "tier", "event_type", "op_type")
    equal = "IS NOT DISTINCT FROM" if null_safe else "="
    same = " AND ".join(f"h.{c} {equal} e.{c}" for c in cols)
    ctes = [_changes(nulls), "h0 AS (SELECT user_id, tier, event_type, op_type, ds FROM e WHERE FALSE)"]
    for i, batches in enumerate(steps, start=1):
        listed = ", ".join(map(str, batches))
        ctes.append(
            f"h{i} AS (SELECT * FROM h{i - 1} UNION ALL SELECT user_id, tier, event_type, op_type, ds "
            f"FROM e WHERE batch_no IN ({listed}) AND NOT EXISTS "
            f"(SELECT 1 FROM h{i - 1} h WHERE {same}))"
        )
    return "WITH " + ", ".join(ctes)


_THREE_STEPS = ((1,), (2,), (3,))

_TWO_STATES = (
    f"WITH {_changes()}, n AS (SELECT * FROM e QUALIFY row_number() OVER "
    '(PARTITION BY "JoinKey" ORDER BY ds DESC NULLS LAST, event_id DESC) = 1), '
    "o AS (SELECT *, CAST(o_orderdate AS DATE) AS ds FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey DESC) = 1) "
    "SELECT 'events' AS feed, \"JoinKey\", tier AS versioned, ds AS \"EffectiveDate\" FROM n UNION ALL "
    "SELECT 'orders', CAST(o_custkey AS VARCHAR), o_orderpriority, ds FROM o"
)

ORACLES: dict[str, str] = {
    "frame_roundtrip": (
        f"SELECT event_id, user_id, event_type, value, props, {_OP} AS op_type, "
        "CAST(ts AS DATE) AS ds FROM events"
    ),
    "unwrap_raw_time": (
        f"SELECT user_id, {_TIER} AS tier, event_type, {_OP} AS op_type, epoch_us(ts) // 1000 AS op_ts, "
        "event_id FROM events"
    ),
    "partition_dates": (
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_millis, "
        "CAST(o_orderdate AS DATE) AS from_days FROM orders"
    ),
    "envelope_partition_date": (
        "WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds, epoch_us(o_orderdate) // 1000 AS ms, "
        "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS days FROM orders) "
        "SELECT 'dna.dbo.orders' AS topic, o_orderkey, ms AS day, ds AS \"day_PARTITION\", "
        "CAST(o_orderkey AS VARCHAR) AS \"JoinKey\", ds FROM o UNION ALL "
        "SELECT 'app.dbo.orders', o_orderkey, days, ds, CAST(o_orderkey AS VARCHAR), ds FROM o"
    ),
    "delete_before_image": (
        f"WITH {_changes()} SELECT user_id, tier, event_type, op_type, ds, event_id AS _offset, "
        '"JoinKey" FROM e'
    ),
    "key_separator": (
        "SELECT l_orderkey, l_linenumber, 'c' AS op_type, CAST(l_shipdate AS DATE) AS ds, "
        "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS \"JoinKey\" FROM lineitem"
    ),
    "join_key": (
        "SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag, "
        "CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) || "
        "coalesce(nullif(l_returnflag, 'N'), '') AS \"JoinKey\" FROM lineitem"
    ),
    "table_names": (
        "WITH t AS (SELECT o_orderpriority || '.dbo.' || o_orderstatus || '.' || "
        "CAST(o_orderkey AS VARCHAR) AS topic FROM orders), "
        "b AS (SELECT topic, replace(regexp_replace(topic, '[.].*[.]', '.', 'g'), '-', '_') AS base "
        "FROM t) SELECT topic, base || '_scd2' AS scd2_table, base || '_hist' AS hist_table FROM b"
    ),
    "latest_per_key": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, "
        "CAST(l_shipdate AS DATE) AS ds FROM lineitem QUALIFY row_number() OVER "
        "(PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE) DESC NULLS LAST, "
        "l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_returnflag DESC NULLS LAST, "
        "l_linestatus DESC NULLS LAST) = 1"
    ),
    "history_append": f"{_history(_THREE_STEPS)} SELECT * FROM h3",
    "history_shuffled": f"{_history(_THREE_STEPS)} SELECT * FROM h3",
    "history_replay": f"{_history(((1,), (1, 2, 3)), nulls=True)} SELECT * FROM h2",
    "history_ledger": f"{_history(((1,), (1, 2, 3)), nulls=True)} SELECT * FROM h2",
    "history_replay_null_safe": (
        f"{_history(((1,), (1, 2, 3)), nulls=True, null_safe=True)} SELECT * FROM h2"
    ),
    "history_upper_case_key": f"{_history(((1,), (1, 2), (3,)))} SELECT * FROM h3",
    "history_sql": (
        f"{_history(_THREE_STEPS)} SELECT ds, op_type, count(*) AS n, "
        "count(DISTINCT user_id) AS users FROM h3 GROUP BY ds, op_type"
    ),
    "flat_history": (
        "WITH a AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'), "
        "b AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'), "
        "h AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE "
        "a.o_orderkey = b.o_orderkey AND a.o_custkey = b.o_custkey AND a.o_orderstatus = "
        "b.o_orderstatus AND a.o_totalprice = b.o_totalprice AND a.o_orderdate = b.o_orderdate "
        "AND a.o_orderpriority = b.o_orderpriority)) "
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM h"
    ),
    "scd2_changed_keys": f"{_chain()} {_changed_keys()}",
    "scd2_staged": (
        f"{_chain()} {_changed_keys('CAST(NULL AS VARCHAR) AS \"mergeKey\", ')} UNION ALL "
        f'SELECT "JoinKey" AS "mergeKey", {_NEW_COLS} FROM n3'
    ),
    "scd2_three_batches": _table(),
    "scd2_shuffled": _table(),
    "scd2_bucketed": _table(),
    "scd2_scd_only": _table(scd=("tier", "event_type"), upd=()),
    "scd2_update_only": _table(scd=(), upd=("tier", "event_type")),
    "scd2_null_default": _table(nulls=True),
    "scd2_null_safe": _table(nulls=True, null_safe=True),
    "scd2_honor_deletes": _table(honor_deletes=True),
    "scd2_reopen": _table(honor_deletes=True, reopen=True),
    "scd2_active_only": _table(active_only=True),
    "scd2_all_changes": _timeline(),
    "scd2_all_changes_one_batch": _timeline(nulls=True),
    "scd2_late_events": _timeline(nulls=True),
    "scd2_partition_date": _table(day=True, upd=("event_type", "day", '"day_PARTITION"')),
    "scd2_replayed_batch": _table(batches=(1, 2, 3, 3)),
    "scd2_batch_ledger": _table(),
    "active_rows": f'{_chain()} SELECT * FROM s3 WHERE "ActiveIndicator"',
    "active_split_files": f'{_chain()} SELECT * FROM s3 WHERE "ActiveIndicator"',
    "delete_edge_cases": (
        f'{_chain()} SELECT "JoinKey", count(*) AS versions, '
        'count(*) FILTER (WHERE "ActiveIndicator") AS active_versions, '
        "count(*) FILTER (WHERE \"ActiveIndicator\" AND \"Action\" = 'd') AS active_deletes, "
        "count(*) FILTER (WHERE NOT \"ActiveIndicator\" AND \"Action\" = 'd') AS closed_by_delete, "
        'max("EffectiveDate") AS last_effective, max("EndDate") AS last_end '
        'FROM s3 GROUP BY "JoinKey"'
    ),
    "partitioned_read": (
        f'WITH {_changes(day=True)} SELECT "JoinKey", user_id AS key_or_scd_user_id, '
        "tier AS key_or_scd_tier, event_type AS overwritten_event_type, day AS overwritten_day, "
        '"day_PARTITION" AS "overwritten_day_PARTITION", op_type, ds FROM e '
        "WHERE \"day_PARTITION\" BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"
    ),
    "explicit_schema_table": (
        "SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, "
        "CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"
    ),
    "csv_scan": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    ),
    "preview_batch": (
        f"WITH {_changes()} SELECT user_id, tier, event_type, op_type, ds, event_id AS _offset, "
        '"JoinKey" FROM e ORDER BY event_id LIMIT 20'
    ),
    "schema_ids": (
        f"WITH {_changes()} SELECT user_id, tier, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type, "
        'op_type, ds, event_id AS _offset, "JoinKey" FROM e'
    ),
    "columns_that_appear": _table(later_type=True),
    "quarantine_good": (
        f"WITH {_changes()} SELECT user_id, tier, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type, "
        "op_type, ds FROM e WHERE event_id % 100 NOT IN (11, 22, 33, 44)"
    ),
    "quarantine_bad": (
        "SELECT 0 AS partition, event_id AS \"offset\", CASE event_id % 100 WHEN 11 THEN 'frame too short' "
        "WHEN 22 THEN 'unknown schema id 9' ELSE 'payload does not fit its schema' END AS reason "
        "FROM events WHERE event_id % 100 IN (11, 22, 33, 44)"
    ),
    "stream_history": f"{_history(_THREE_STEPS)} SELECT * FROM h3",
    "stream_scd2": _table(),
    "stream_new_checkpoint": _table(batches=((1,), (1, 2), (3,))),
    "two_change_feeds": _TWO_STATES,
    "one_source_feeds": _TWO_STATES,
    "multi_feed_counts": (
        "SELECT 'events_hist' AS feed_table, count(*) AS rows FROM events UNION ALL "
        "SELECT 'events_scd2', count(DISTINCT user_id) FROM events UNION ALL "
        "SELECT 'orders_flat', count(*) FROM orders"
    ),
}
