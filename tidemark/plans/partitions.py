"""Replace whole partitions of a catalog table by pointing them at new folders.

A merge rewrites only the partitions it changes. The new files go to a fresh
folder inside the table location; once they are complete, each partition's
catalog location is moved over. Readers see the old or the new files of a
partition, never a mixture, and nothing is copied twice. The intent is stored
in a table property first, so a driver that dies half way finishes the move
when the table is next written.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import KEY_BUCKET
from tidemark.sources.tables import TableRef, _text

PENDING = "tidemark.pending"
APPLIED = "tidemark.applied."
_MOVES = "_moves"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Delivery:
    """A batch of a streaming query; batch numbers of different checkpoints are unrelated.

    ``query`` is the id kept in the query's checkpoint.
    """

    query: str
    batch: int

    @property
    def text(self) -> str:
        return f"{self.batch}@{self.query}"

    @staticmethod
    def parse(text: str) -> Delivery | None:
        batch, _, query = text.partition("@")
        return Delivery(query, int(batch)) if batch else None


@dataclass(frozen=True)
class Move:
    """A partition (dates as text, null as None) whose files are replaced or gone."""

    part: str | None
    emptied: bool = False
    bucket: str | None = None  # of tables with key buckets


def distinct_values(df: DataFrame, column: str) -> list:
    """Partition values in ``df``: at most one entry per partition of the table,
    i.e. no more than the driver lists for any scan of it."""
    return [r[0] for r in df.select(column).distinct().collect()]


def in_partitions(column: str, values: Iterable) -> Column:
    """Static partition filter; nulls are a partition of their own."""
    values = list(values)
    known = [v for v in values if v is not None]
    tests = [F.col(column).isin(known)] if known else []
    if len(known) < len(values):
        tests.append(F.col(column).isNull())
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def distinct_places(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """As :func:`distinct_values`, for one or two partition columns."""
    return [tuple(r) for r in df.select(*columns).distinct().collect()]


def in_places(columns: Sequence[str], places: Iterable[tuple]) -> Column:
    """Static partition filter over one or two partition columns."""
    if len(columns) == 1:
        return in_partitions(columns[0], [p[0] for p in places])
    by_bucket: dict[int, list] = {}
    for part, bucket in places:
        by_bucket.setdefault(bucket, []).append(part)
    tests = [(F.col(columns[1]) == b) & in_partitions(columns[0], parts) for b, parts in by_bucket.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _spec(table: TableRef, text: str | None, bucket: str | None = None) -> str:
    value = "null" if text is None else _text(text)
    more = "" if bucket is None else f", `{KEY_BUCKET}` = {bucket}"
    return f"PARTITION (`{table.partition_col}` = {value}{more})"


def properties(spark: SparkSession, table: TableRef) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table.sql_name}").collect()
    return {r["key"]: r["value"] for r in rows}


def set_properties(spark: SparkSession, table: TableRef, **values: str) -> None:
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table.sql_name} SET TBLPROPERTIES ({pairs})")


def was_applied(stored: dict[str, str], delivery: Delivery | None) -> bool:
    return delivery is not None and int(stored.get(APPLIED + delivery.query, -1)) >= delivery.batch


def applied(delivery: Delivery | None) -> dict[str, str]:
    return {APPLIED + delivery.query: str(delivery.batch)} if delivery else {}


def mark_applied(spark: SparkSession, table: TableRef, delivery: Delivery | None) -> None:
    if delivery is not None:
        set_properties(spark, table, **applied(delivery))


def add_partitions(spark: SparkSession, table: TableRef, folders: Sequence[str]) -> None:
    """Register the partitions of ``folders`` (``column=value``) at their place below the table, if they are not."""
    texts = [unquote(folder.partition("=")[2]) for folder in folders]
    places = " ".join(_spec(table, None if text == _NULL_FOLDER else text) for text in texts)
    if places:
        spark.sql(f"ALTER TABLE {table.sql_name} ADD IF NOT EXISTS {places}")


def _or_null(text: str | None) -> str:
    return "null" if text is None else _text(text)


def replace_partitions(
    spark: SparkSession,
    table: TableRef,
    folder: str,
    moves: Sequence[Move],
    delivery: Delivery | None,
) -> None:
    """Point the partitions in ``moves`` at their folders below ``folder``."""
    values = ", ".join(
        f"({_or_null(m.part)}, {str(m.emptied).lower()}, {_or_null(m.bucket)})" for m in moves
    )
    listed = spark.sql(f"SELECT * FROM VALUES {values} AS moves(part, emptied, bucket)")
    texts = [f"CAST({c} AS STRING) AS {c}" for c in ("part", "bucket")]
    listed.selectExpr("emptied", *texts).coalesce(1).write.parquet(
        f"{folder}/{_MOVES}"
    )
    set_properties(spark, table, **{PENDING: f"{delivery.text if delivery else ''}|{folder}"})
    _move(spark, table, folder, moves, delivery)


def finish_pending(spark: SparkSession, table: TableRef) -> dict[str, str]:
    """Carry out a move a lost driver left behind; returns the table's properties."""
    stored = properties(spark, table)
    text, _, folder = stored.get(PENDING, "").partition("|")
    if not folder:
        return stored
    delivery = Delivery.parse(text)
    schema = "part STRING, emptied BOOLEAN, bucket STRING"
    listed = spark.read.schema(schema).parquet(f"{folder}/{_MOVES}")
    moves = [Move(r["part"], r["emptied"], r["bucket"]) for r in listed.collect()]
    _move(spark, table, folder, moves, delivery)
    return stored | applied(delivery)


def _move(
    spark: SparkSession, table: TableRef, folder: str, moves: Sequence[Move], delivery: Delivery | None
) -> None:
    """Repeatable: every statement states where a partition is, not how it changes."""
    name = table.sql_name

    def folder_of(move: Move) -> str:
        text = _NULL_FOLDER if move.part is None else move.part
        below = "" if move.bucket is None else f"/{KEY_BUCKET}={move.bucket}"
        return f"{table.partition_col}={text}{below}"

    def location(move: Move) -> str:
        return f"{folder}/{folder_of(move)}"

    existing = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    filled = [m for m in moves if not m.emptied]
    moved = {(m.part, m.bucket): location(m) for m in filled if folder_of(m) in existing}
    added = [m for m in filled if folder_of(m) not in existing]
    emptied = [_spec(table, m.part, m.bucket) for m in moves if m.emptied]
    # A catalog call each, however many partitions there are.
    if moved:
        _set_locations(spark, table, moved)
    if added:
        places = " ".join(f"{_spec(table, m.part, m.bucket)} LOCATION {_text(location(m))}" for m in added)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    if emptied:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(emptied)}")
    set_properties(spark, table, **{PENDING: ""}, **applied(delivery))


def _set_locations(spark: SparkSession, table: TableRef, places: dict[tuple[str | None, str | None], str]) -> None:
    """Move the catalog locations of existing partitions, all at once.

    SQL moves one partition per statement; the session's catalog takes a list.
    """
    scala = spark._jvm.scala
    state = spark._jsparkSession.sessionState()
    catalog, ident = state.catalog(), state.sqlParser().parseTableIdentifier(table.sql_name)
    some = getattr(scala, "Option").apply
    uri = spark._jvm.org.apache.spark.sql.catalyst.catalog.CatalogUtils.stringToURI
    columns = table.partition_cols
    # Partitions of a table differ in their place alone.
    like = catalog.getTableMetadata(ident).storage()
    formats = (like.inputFormat(), like.outputFormat(), like.serde(), like.compressed(), like.properties())
    never, unknown = -1, some(None)
    altered = spark._jvm.java.util.ArrayList()
    for old in scala.jdk.javaapi.CollectionConverters.asJava(catalog.listPartitions(ident, some(None))):
        spec = old.spec()
        values = [spec.apply(c) for c in columns]
        part = None if values[0] in (None, _NULL_FOLDER) else values[0]
        place = places.get((part, values[1] if len(columns) > 1 else None))
        if place is not None:
            altered.add(old.copy(spec, like.copy(some(uri(place)), *formats), old.parameters(), old.createTime(), never, unknown))
    if altered.size() != len(places):
        raise RuntimeError(f"{len(places)} partitions to move in {table.name}, {altered.size()} found")
    catalog.alterPartitions(ident, scala.jdk.javaapi.CollectionConverters.asScala(altered).toSeq())
    spark.catalog.refreshTable(table.sql_name)


def stale_versions(spark: SparkSession, table: TableRef) -> list[str]:
    """Folders of earlier merges that no partition points at any more, and no pending move either."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{table.location}/_versions")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    folders = {s.getPath().getName(): s.getPath().toString() for s in files.listStatus(root)}
    live = {properties(spark, table).get(PENDING, "").rpartition("/")[2]}
    for row in spark.sql(f"SHOW PARTITIONS {table.sql_name}").collect():
        value, *more = (level.partition("=")[2] for level in row[0].split("/"))
        spec = _spec(table, None if value == _NULL_FOLDER else value, *more)
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table.sql_name} {spec}")
        for place in detail.where("col_name = 'Location'").collect():
            _, found, rest = place["data_type"].partition("/_versions/")
            if found:
                live.add(rest.split("/")[0])
    return sorted(path for name, path in folders.items() if name not in live)


def remove_stale_versions(spark: SparkSession, table: TableRef, dry_run: bool = True) -> list[str]:
    """Delete those folders; with ``dry_run`` (the default) only list them.

    Queries that were planned before the last merges may still read them: run it when none is.
    """
    stale = stale_versions(spark, table)
    for folder in [] if dry_run else stale:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return stale
