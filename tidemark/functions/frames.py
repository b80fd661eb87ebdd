"""Wire frame, payload, envelope and encoded dates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: one magic byte and a four-byte schema id precede the payload.
FRAME_BYTES = 5


def strip_frame(value: Column) -> Column:
    """Payload of a framed binary message."""
    return F.substring(value, F.lit(FRAME_BYTES + 1), F.length(value) - FRAME_BYTES)


def decode_payload(payload: Column, schema: str, payload_format: str) -> Column:
    """Payload bytes to a struct; a null message becomes a null struct.

    A payload that does not fit the schema fails the batch, in either format.
    ``json``: ``schema`` is DDL. ``avro``: ``schema`` is the writer schema as JSON
    text and Spark's avro package must be on the classpath.
    """
    if payload_format == "json":
        return F.from_json(F.decode(payload, "UTF-8"), schema, {"mode": "FAILFAST"})
    if payload_format == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema)
    raise ValueError(f"unknown payload format: {payload_format}")


def envelope_ddl(after_ddl: str) -> str:
    return (
        f"before STRUCT<{after_ddl}>, after STRUCT<{after_ddl}>, "
        "op STRING, source STRUCT<ts_ms: BIGINT>, ts_ms BIGINT"
    )


def decode_topic(
    frames: DataFrame,
    schema: str,
    payload_format: str = "json",
    carry: Iterable[tuple[str, str]] = (),
) -> DataFrame:
    """Topic rows to ``data`` plus the transport columns needed for ordering."""
    data = decode_payload(strip_frame(F.col("value")), schema, payload_format)
    return frames.select(data.alias("data"), *[F.col(src).alias(dst) for src, dst in carry])


# Frames that say which schema they were written with, and frames that fit none ----

CORRUPT = "_corrupt"
REASON, FRAME = "_bad_reason", "_bad_frame"


def schema_id(value: Column) -> Column:
    """The number in bytes 2 to 5 of a frame."""
    return F.conv(F.hex(F.substring(value, 2, FRAME_BYTES - 1)), 16, 10).cast("bigint")


def widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is one of the other."""
    # The widening steps that lose nothing.
    order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if have == want:
        return True
    if want == T.StringType() and isinstance(have, (T.NumericType, T.DateType, T.BooleanType)):
        return True
    if have in order:
        exact = want == T.DoubleType() and have != T.LongType()
        return exact or (want in order and order.index(have) < order.index(want))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return all(f.name in have.names and widens(have[f.name].dataType, f.dataType) for f in want.fields)
    return (have, want) == (T.FloatType(), T.DoubleType()) or (have, want) == (T.DateType(), T.TimestampType())


def check_fits(after_ddl: str, schemas: Mapping[int, str]) -> None:
    """Refuse schemas with a column that the feed's own would narrow."""
    want = T.StructType.fromDDL(after_ddl)
    for number, ddl in schemas.items():
        have = T.StructType.fromDDL(ddl)
        for f in want.fields:
            if f.name in have.names and not widens(have[f.name].dataType, f.dataType):
                raise ValueError(f"schema {number}: {f.name} is {have[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")


def _reconciled(data: Column, have: T.StructType, want: T.StructType) -> Column:
    """An envelope in the feed's own schema: columns it does not have are null, further ones are left out."""

    def image(name: str) -> Column:
        own = data[name]
        cols = [
            (own[f.name].cast(f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(own.isNotNull(), F.struct(*cols)).alias(name)

    rest = [data[c].alias(c) for c in ("op", "source", "ts_ms")]
    return F.when(data.isNotNull(), F.struct(image("before"), image("after"), *rest))


def decode_changes(
    frames: DataFrame,
    after_ddl: str,
    schemas: Mapping[int, str],
    carry: Iterable[tuple[str, str]] = (),
    quarantine: bool = False,
) -> DataFrame:
    """Framed JSON envelopes to ``data``, each by the schema its frame names.

    ``schemas``: columns of the table by schema id; without any, ids are not looked at. A frame that is too
    short, an unknown id, or a payload that does not fit its schema fails the batch, or, with ``quarantine``,
    gives a row whose ``_bad_reason`` is set, next to the frame as it came. Null messages are rows of nulls.
    """
    check_fits(after_ddl, schemas)
    want = T.StructType.fromDDL(after_ddl)
    value, number = F.col("value"), schema_id(F.col("value"))
    text = F.decode(strip_frame(value), "UTF-8")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    data = corrupt = F.lit(None)
    for known, ddl in (schemas or {None: after_ddl}).items():
        parsed = F.from_json(text, f"{envelope_ddl(ddl)}, {CORRUPT} STRING", options)
        own = F.lit(True) if known is None else number == known
        data = F.when(own, _reconciled(parsed, T.StructType.fromDDL(ddl), want)).otherwise(data)
        corrupt = F.when(own, parsed[CORRUPT]).otherwise(corrupt)
    reason = F.when(F.length(value) < FRAME_BYTES, F.lit("frame too short"))
    if schemas:
        reason = reason.when(value.isNotNull() & ~number.isin(*schemas), F.concat(F.lit("unknown schema id "), number.cast("string")))
    reason = reason.when(corrupt.isNotNull(), F.lit("payload does not fit its schema"))
    rows = frames.select(
        data.alias("data"),
        reason.alias(REASON),
        F.struct(*[F.col(c) for c in ("value", "topic", "partition", "offset")]).alias(FRAME),
        *[F.col(src).alias(dst) for src, dst in carry],
    )
    if quarantine:
        return rows
    failing = F.when(F.col(REASON).isNotNull(), F.raise_error(F.col(REASON))).otherwise(F.col("data"))
    return rows.withColumn("data", failing).drop(REASON, FRAME)


def date_from_millis(millis: Column) -> Column:
    """Epoch milliseconds to a date in the session zone, cut to whole seconds."""
    return F.to_date(F.timestamp_seconds((millis / 1000).cast("bigint")))


def date_from_days(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def unwrap_change(
    decoded: DataFrame,
    transport: Iterable[str] = (),
    partition_col: str | None = None,
    partition_in_millis: bool = False,
    delete_image: str = "after",
) -> DataFrame:
    """Envelope to ``<after columns>, op_type, ds [, <p>_PARTITION]``.

    A row whose ``after`` is null stays, with all payload columns null. With
    ``delete_image="before"`` such rows take their columns from the old image.
    """
    if delete_image == "before":
        image = F.coalesce(F.col("data.after"), F.col("data.before"))
        decoded = decoded.withColumn("data", F.col("data").withField("after", image))
    columns = [
        F.col("data.after.*"),
        F.col("data.op").alias("op_type"),
        date_from_millis(F.col("data.source.ts_ms")).alias("ds"),
    ]
    if partition_col:
        encoded = F.col(f"data.after.{partition_col}")
        to_date = date_from_millis if partition_in_millis else date_from_days
        columns.append(to_date(encoded).alias(f"{partition_col}_PARTITION"))
    return decoded.select(*columns, *transport)


def unwrap_change_raw_time(decoded: DataFrame, transport: Iterable[str] = ()) -> DataFrame:
    """Envelope to ``<after columns>, op_type, op_ts`` with the top-level time as a long."""
    return decoded.select(
        "data.after.*",
        F.col("data.op").alias("op_type"),
        F.col("data.ts_ms").alias("op_ts"),
        *transport,
    )


def unwrap_flat(decoded: DataFrame) -> DataFrame:
    """Flat record plus the processing date."""
    return decoded.select("data.*", F.current_date().alias("ds"))
