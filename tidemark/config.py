"""Feed configuration and the column names every module agrees on."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the normalised change row and of the tables.
JOIN_KEY = "JoinKey"
BOOKKEEPING = ("op_type", "ds", "table", "scn", "current_ts", "row_id", "username")
SCD_COLUMNS = ("ActiveIndicator", "EffectiveDate", "EndDate", "Action")
PARTITION_SUFFIX = "_PARTITION"
KEY_BUCKET = "_key_bucket"
# Code of a delete, and the start of topics whose partition column is in milliseconds.
DELETE_OP = "d"
MILLIS_TOPICS = "dna"

# Transport columns kept next to the decoded row so that "latest" has a total
# order. They are used for ordering only and never reach a table.
DEFAULT_CARRY = (("partition", "_partition"), ("offset", "_offset"))

# A side is broadcast only when its measured size is at most this many bytes.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

# A key with at least this many versions is spread over several tasks when the
# table has to be shuffled.
DEFAULT_HOT_VERSIONS = 1_000_000


@dataclass(frozen=True)
class MergeRules:
    """Opt-in departures from the default merge behaviour (all off)."""

    null_safe: bool = False  # null <-> value counts as a change / null = null in history
    honor_deletes: bool = False  # a delete row never inserts a version
    reopen: bool = False  # a key with only closed versions gets a new active one
    active_only_overwrite: bool = False  # closed versions are never overwritten
    # Every change of a batch counts, not the newest of a key alone; needs the first three.
    every_change: bool = False
    # Changes are placed by their own time, whenever they arrive; needs ``every_change`` and keeps all changes
    # in a table of their own.
    by_time: bool = False

    def __post_init__(self) -> None:
        if self.by_time and not self.every_change:
            raise ValueError("by_time needs every_change")
        if self.every_change and not (self.null_safe and self.honor_deletes and self.reopen):
            raise ValueError("every_change needs null_safe, honor_deletes and reopen")


# All changes of a key, in the order of their time.
TIMELINE = MergeRules(null_safe=True, honor_deletes=True, reopen=True, every_change=True)

@dataclass(frozen=True)
class CdcFeed:
    """One change topic: envelope with ``after``, ``op`` and ``source.ts_ms``."""

    topic: str
    after_ddl: str
    key_cols: tuple[str, ...]
    scd_cols: tuple[str, ...] = ()
    order_cols: tuple[str, ...] = ("_offset",)
    partition_col: str | None = None
    partition_encoding: str | None = None  # "millis" | "days"; None: by topic name
    carry: tuple[tuple[str, str], ...] = DEFAULT_CARRY
    key_sep: str = ""
    delete_image: str = "after"  # "before": take the key of deletes from the old image
    payload_format: str = "json"  # "avro" where Spark's avro package is loaded
    avro_schema: str | None = None  # envelope schema as JSON text, for "avro"
    # Columns by the schema id in the frame, where messages of several schemas share the topic (JSON only);
    # each is decoded with its own and brought to ``after_ddl``. An unknown id fails the batch.
    schemas: tuple[tuple[int, str], ...] = ()
    # Messages that cannot be decoded go to a table of their own instead of failing the batch (JSON only).
    quarantine: bool = False
    table_format: str = "parquet"  # "delta"/"iceberg": the format's own MERGE is used
    # Versioned table only: a second partition level by a hash of the key, so that a merge rewrites
    # date x bucket instead of whole dates. Fixed when the table is created.
    key_buckets: int = 0
    # Versioned table only: active and closed versions in files of their own, so that the current state is read
    # without opening a file of closed ones. Fixed when the table is created.
    split_active: bool = False
    batch_ledger: bool = False  # apply a batch of a checkpoint once, in both tables
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    hot_versions: int = DEFAULT_HOT_VERSIONS
    rules: MergeRules = field(default_factory=MergeRules)

    def __post_init__(self) -> None:
        if (self.schemas or self.quarantine) and self.payload_format != "json":
            raise ValueError("schemas and quarantine are for JSON payloads")

    @property
    def transport(self) -> tuple[str, ...]:
        return tuple(alias for _, alias in self.carry)

    @property
    def partition_date_col(self) -> str | None:
        return f"{self.partition_col}{PARTITION_SUFFIX}" if self.partition_col else None

    @property
    def partition_in_millis(self) -> bool:
        """Some topics carry epoch milliseconds, all others epoch days."""
        if self.partition_encoding is not None:
            return self.partition_encoding == "millis"
        return self.topic.startswith(MILLIS_TOPICS)

    @property
    def scd2_partition(self) -> str:
        return self.partition_date_col or "EffectiveDate"

    @property
    def history_partition(self) -> str:
        return self.partition_date_col or "ds"


@dataclass(frozen=True)
class FlatFeed:
    """One topic of plain records (no envelope); history only."""

    topic: str
    record_ddl: str
    payload_format: str = "json"
    avro_schema: str | None = None
    # Selective columns, if any: they tell which partitions can hold an equal row.
    key_cols: tuple[str, ...] = ()
    table_format: str = "parquet"
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    rules: MergeRules = field(default_factory=MergeRules)
