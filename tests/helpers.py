"""Small change feeds for the tests."""

from __future__ import annotations

import datetime as dt
import uuid

from tidemark.config import CdcFeed
from tidemark.functions.keys import with_business_key
from tidemark.streaming.feeds import prepare_tables

AFTER = "id BIGINT, price STRING, name STRING"
ROW = "id BIGINT, price STRING, name STRING, op_type STRING, ds DATE, _offset BIGINT"


def day(n):
    return dt.date(2024, 1, n)


def feed(**changes):
    settings = dict(
        topic=f"t{uuid.uuid4().hex[:10]}.dbo.items",
        after_ddl=AFTER,
        key_cols=("id",),
        scd_cols=("price",),
        carry=(("offset", "_offset"),),
    )
    settings.update(changes)
    return CdcFeed(**settings)


def rows(spark, *tuples):
    """(id, price, name, op_type, day of month or None[, offset]) to a change frame."""
    full = []
    for i, t in enumerate(tuples):
        key, price, name, op, d = t[:5]
        offset = t[5] if len(t) > 5 else i
        full.append((key, price, name, op, None if d is None else day(d), offset))
    return with_business_key(spark.createDataFrame(full, ROW), ["id"])


def tables(spark, change_rows, a_feed, tmp_path):
    return prepare_tables(spark, change_rows, a_feed, str(tmp_path))


def versions(df):
    """Rows as sorted tuples (key, price, name, active, from, to, action), days as numbers."""
    picked = df.select(
        "JoinKey", "price", "name", "ActiveIndicator", "EffectiveDate", "EndDate", "Action"
    ).collect()
    return sorted(
        (
            (r[0], r[1], r[2], r[3], r[4] and r[4].day, r[5] and r[5].day, r[6])
            for r in picked
        ),
        key=repr,
    )
