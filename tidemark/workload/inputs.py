"""Change feeds derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CdcFeed, FlatFeed, MergeRules
from tidemark.functions.keys import with_business_key

# Fixed values of the derived feeds; the oracle SQL states the same ones.
LOW_BELOW, MID_BELOW = 50, 150
BATCH_DAYS = (10, 20)
FRAME_HEADER = bytearray([0, 0, 0, 0, 1])
EVENTS_DDL = "user_id BIGINT, tier STRING, event_type STRING"
EVENTS_DAY_DDL = EVENTS_DDL + ", day INT"
ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_feed(topic: str = "app.dbo.events", **changes) -> CdcFeed:
    settings = dict(
        topic=topic,
        after_ddl=EVENTS_DDL,
        key_cols=("user_id",),
        scd_cols=("tier",),
        carry=(("offset", "_offset"),),
        rules=MergeRules(),
    )
    settings.update(changes)
    return CdcFeed(**settings)


def orders_feed(topic: str = "orders") -> FlatFeed:
    return FlatFeed(topic=topic, record_ddl=ORDERS_DDL, key_cols=("o_orderkey",))


def tier(value: Column) -> Column:
    return (
        F.when(value < LOW_BELOW, "low").when(value < MID_BELOW, "mid").otherwise("high")
    )


def op_code(event_type: Column) -> Column:
    return F.when(event_type == "signup", "c").when(event_type == "error", "d").otherwise("u")


def batch_number(ts: Column) -> Column:
    day = F.dayofmonth(ts)
    return F.when(day <= BATCH_DAYS[0], 1).when(day <= BATCH_DAYS[1], 2).otherwise(3)


def event_changes(
    spark: SparkSession, sf_dir: str, nulls: bool = False, day: bool = False
) -> DataFrame:
    """Normalised change rows from ``events``, with ``_offset`` and ``batch_no``.

    ``nulls`` turns the middle tier into null; ``day`` adds the event day as epoch
    days and its partition date.
    """
    level = tier(F.col("value"))
    if nulls:
        level = F.nullif(level, F.lit("mid"))
    payload = [F.col("user_id"), level.alias("tier"), F.col("event_type")]
    dates = [F.to_date("ts").alias("ds")]
    if day:
        payload.append(F.unix_date(F.to_date("ts")).alias("day"))
        dates.append(F.to_date("ts").alias("day_PARTITION"))
    rows = table(spark, sf_dir, "events").select(
        *payload,
        op_code(F.col("event_type")).alias("op_type"),
        *dates,
        F.col("event_id").alias("_offset"),
        batch_number(F.col("ts")).alias("batch_no"),
    )
    return with_business_key(rows, ["user_id"])


def event_batch(changes: DataFrame, number: int | tuple[int, ...]) -> DataFrame:
    """One batch, or several as one."""
    numbers = number if isinstance(number, tuple) else (number,)
    return changes.where(F.col("batch_no").isin(*numbers)).drop("batch_no")


def frame(payload: Column, header: bytes = bytes(FRAME_HEADER)) -> Column:
    """JSON payload behind the five-byte header."""
    return F.concat(F.lit(header), F.encode(F.to_json(payload), "UTF-8"))


# Schema ids of the feed of two schemas, by their columns; the first has no event type yet, and small user ids.
TWO_SCHEMAS = ((1, "user_id INT, tier STRING"), (7, EVENTS_DDL))


def two_schema_frames(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Events of even id written with the first schema, the others with the second."""
    rows = table(spark, sf_dir, "events").withColumn("tier", tier(F.col("value")))
    parts = []
    for rest, (number, ddl) in enumerate(TWO_SCHEMAS):
        names = [part.split()[0] for part in ddl.split(", ")]
        own = rows.where(F.col("event_id") % 2 == rest)
        frames = change_frames(own, names, F.col("ts"), op_code(F.col("event_type")), F.col("event_id"), topic)
        header = bytes([0]) + number.to_bytes(4, "big")
        parts.append(frames.withColumn("value", F.concat(F.lit(header), F.substring("value", F.lit(6), F.length("value")))))
    return parts[0].unionByName(parts[1])


def damaged_frames(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The feed of two schemas with messages that fit none, by the last digits of their offset."""
    rest = F.col("offset") % 100
    cut = F.substring("value", F.lit(1), F.length("value") - 9)
    value = (
        F.when(rest == 11, F.substring("value", F.lit(1), F.lit(3)))
        .when(rest == 22, F.concat(F.lit(bytes([0, 0, 0, 0, 9])), F.substring("value", F.lit(6), F.length("value"))))
        .when(rest == 33, cut)
        .when(rest == 44, F.concat(F.lit(bytes([0, 0, 0, 0, 7])), F.encode(F.lit('{"after": {"user_id": "none"}, "op": "c"}'), "UTF-8")))
        .otherwise(F.col("value"))
    )
    return two_schema_frames(spark, sf_dir, topic).withColumn("value", value)


def change_frames(rows: DataFrame, after: list[str], ts: Column, op: Column, offset: Column,
                  topic: str, old_image: bool = False) -> DataFrame:
    """Kafka-shaped rows with a change envelope as payload.

    With ``old_image`` a delete has its columns in ``before`` and no ``after``.
    """
    millis = F.unix_millis(ts.cast("timestamp"))
    images = [F.struct(*after).alias("after")]
    if old_image:
        gone = op == "d"
        images = [F.when(gone, F.struct(*after)).alias("before"), F.when(~gone, F.struct(*after)).alias("after")]
    envelope = F.struct(
        *images,
        op.alias("op"),
        F.struct(millis.alias("ts_ms")).alias("source"),
        millis.alias("ts_ms"),
    )
    return rows.select(
        frame(envelope).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
    )


def event_frames(
    spark: SparkSession, sf_dir: str, topic: str, old_image: bool = False
) -> DataFrame:
    """The feed of :func:`event_changes` as framed messages, plus ``batch_no``."""
    rows = table(spark, sf_dir, "events").withColumn("tier", tier(F.col("value")))
    frames = change_frames(
        rows,
        ["user_id", "tier", "event_type"],
        F.col("ts"),
        op_code(F.col("event_type")),
        F.col("event_id"),
        topic,
        old_image,
    )
    return frames.withColumn("batch_no", batch_number(F.col("timestamp")))


def order_changes_feed(topic: str, **changes) -> CdcFeed:
    return events_feed(
        topic=topic,
        after_ddl="o_custkey BIGINT, o_orderpriority STRING, o_orderkey BIGINT",
        key_cols=("o_custkey",),
        scd_cols=("o_orderpriority",),
        **changes,
    )


def order_frames(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Every order as a change of its customer's last priority."""
    columns = ["o_custkey", "o_orderpriority", "o_orderkey"]
    orders = table(spark, sf_dir, "orders")
    return change_frames(orders, columns, F.col("o_orderdate"), F.lit("u"), F.col("o_orderkey"), topic)


def flat_frames(rows: DataFrame, topic: str, offset: Column) -> DataFrame:
    return rows.select(
        frame(F.struct(*rows.columns)).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
