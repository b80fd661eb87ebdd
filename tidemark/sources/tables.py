"""Catalog tables: create if absent, open, read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import BOOKKEEPING, JOIN_KEY, KEY_BUCKET, SCD_COLUMNS
from tidemark.functions.frames import widens
from tidemark.functions.keys import ACTIVE, columns_except
from tidemark.functions.naming import quoted


@dataclass(frozen=True)
class TableRef:
    name: str
    partition_col: str | None
    location: str
    format: str = "parquet"
    key_buckets: int = 0
    split_active: bool = False

    @property
    def partition_cols(self) -> list[str]:
        if not self.partition_col:
            return []
        return [self.partition_col, KEY_BUCKET] if self.key_buckets else [self.partition_col]

    @property
    def sql_name(self) -> str:
        return quoted(self.name)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Table property holding the number of key buckets.
BUCKETS = "tidemark.key_buckets"
# Table property: active and closed versions are in files of their own; and how the names of those begin.
SPLIT = "tidemark.split_active"
OPEN_FILES, CLOSED_FILES = "open", "closed"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")


def scd2_schema(row_schema: T.StructType) -> T.StructType:
    """Change row without bookkeeping columns, plus the four version columns."""
    payload = [f for f in row_schema.fields if f.name not in BOOKKEEPING]
    # Types of ActiveIndicator, EffectiveDate, EndDate, Action.
    added = zip(SCD_COLUMNS, (T.BooleanType(), T.DateType(), T.DateType(), T.StringType()))
    return T.StructType(
        [T.StructField(f.name, f.dataType) for f in payload]
        + [T.StructField(name, kind) for name, kind in added]
    )


def history_schema(row_schema: T.StructType) -> T.StructType:
    kept = columns_except(row_schema.names, [JOIN_KEY])
    return T.StructType([T.StructField(n, row_schema[n].dataType) for n in kept])


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType | str,
    location: str,
    partition_col: str | None = None,
    table_format: str = "parquet",
    comment: str | None = None,
    key_buckets: int = 0,
    split_active: bool = False,
) -> TableRef:
    """Table with an explicit schema at a location, unless it exists."""
    if spark.catalog.tableExists(quoted(name)):
        return open_table(spark, name)
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    table = TableRef(name, partition_col, location, table_format, key_buckets, split_active)
    by = f" PARTITIONED BY ({', '.join(map(quoted, table.partition_cols))})" if partition_col else ""
    settings = {BUCKETS: key_buckets, SPLIT: "true" if split_active else ""}
    pairs = ", ".join(f"{_text(k)} = {_text(str(v))}" for k, v in settings.items() if v)
    kept = f" TBLPROPERTIES ({pairs})" if pairs else ""
    note = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({ddl}) USING {table_format}"
        f"{by} LOCATION {_text(location)}{note}{kept}"
    )
    return table


def fit_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Bring an existing table to ``schema``: columns it lacks are added, null in the rows it has.

    Refused are types the table's own would narrow, and rows without a column that the table has.
    """
    stored = {f.name.lower(): f for f in spark.table(quoted(name)).schema.fields if f.name != KEY_BUCKET}
    wanted = {f.name.lower(): f for f in schema.fields if f.name != KEY_BUCKET}
    for key, field in stored.items():
        if key not in wanted:
            raise ValueError(f"{name} has a column {field.name}, the rows do not")
        if not widens(wanted[key].dataType, field.dataType):
            have, want = wanted[key].dataType.simpleString(), field.dataType.simpleString()
            raise ValueError(f"{name}: {field.name} is {want}, which cannot hold {have}")
    added = [f"{quoted(f.name)} {f.dataType.simpleString()}" for key, f in wanted.items() if key not in stored]
    if added:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({', '.join(added)})")


def create_scd2_table(
    spark: SparkSession,
    name: str,
    row_schema: T.StructType,
    partition_col: str,
    location: str,
    table_format: str = "parquet",
    key_buckets: int = 0,
    split_active: bool = False,
) -> TableRef:
    schema = scd2_schema(row_schema)
    if spark.catalog.tableExists(quoted(name)):
        fit_columns(spark, name, schema)
    if key_buckets:
        schema = T.StructType([*schema.fields, T.StructField(KEY_BUCKET, T.IntegerType())])
    return create_table(
        spark, name, schema, location, partition_col, table_format, None, key_buckets, split_active
    )


def create_history_table(
    spark: SparkSession,
    name: str,
    row_schema: T.StructType,
    partition_col: str,
    location: str,
    table_format: str = "parquet",
) -> TableRef:
    schema = history_schema(row_schema)
    if spark.catalog.tableExists(quoted(name)):
        fit_columns(spark, name, schema)
    return create_table(spark, name, schema, location, partition_col, table_format)


def create_changes_table(
    spark: SparkSession, name: str, row_schema: T.StructType, order_cols: Sequence[str], location: str
) -> TableRef:
    """Every change row as it came, key and order columns included, by day."""
    missing = [c for c in order_cols if c not in row_schema.names]
    if missing:
        raise ValueError(f"changes are placed by {', '.join(missing)}, which the rows do not have")
    if spark.catalog.tableExists(quoted(name)):
        fit_columns(spark, name, row_schema)
    return create_table(spark, name, row_schema, location, "ds")


def open_table(spark: SparkSession, name: str) -> TableRef:
    """Look a table up in the catalog; what other sessions wrote is seen from here on."""
    spark.catalog.refreshTable(quoted(name))
    partitions = [c.name for c in spark.catalog.listColumns(quoted(name)) if c.isPartition]
    detail = {
        r["col_name"]: r["data_type"]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}")
        .where(F.col("col_name").isin("Location", "Provider"))
        .collect()
    }
    stored = _settings(spark, name)
    return TableRef(
        name=name,
        partition_col=partitions[0] if partitions else None,
        location=detail["Location"],
        format=detail["Provider"].lower(),
        key_buckets=int(stored[BUCKETS]) if KEY_BUCKET in partitions else 0,
        split_active=SPLIT in stored,
    )


def _settings(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def not_in_files(first_name: str) -> str:
    """Leaves files out by their name, which is decided while they are listed: none of them is opened."""
    return f"NOT startswith(_metadata.file_name, '{first_name}-')"


def active_rows(spark: SparkSession, name: str) -> DataFrame:
    """Current state of a versioned table; with ``split_active`` files of closed versions are not opened."""
    spark.catalog.refreshTable(quoted(name))
    rows = spark.table(quoted(name)).where(ACTIVE)
    if SPLIT in _settings(spark, name):
        rows = rows.where(not_in_files(CLOSED_FILES))
    return rows.drop(KEY_BUCKET)


def query_table(spark: SparkSession, name: str, columns: str = "*") -> DataFrame:
    """Plain SQL over a table of the catalog."""
    spark.catalog.refreshTable(quoted(name))
    return spark.sql(f"SELECT {columns} FROM {quoted(name)}")
