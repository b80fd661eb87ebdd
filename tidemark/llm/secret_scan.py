"""Secret scan over content-addressed blobs with an incremental ledger.

Every version of a file is addressed by the SHA-256 of its text (null counts as empty). A ledger table
holds the (blob, rules version) pairs already scanned and their findings. A run digests all versions,
takes one witness per blob whose pair is not in the ledger, scans these texts only, appends to the
ledger, and joins the findings back to every version with that content.

Base kinds, leftmost and non-overlapping each: assign, access, hex. Further kinds of this method: pem,
jwt, github, slack, google. Spans are code points, end exclusive. Repeated rows and copies all get the
findings of their content; rows without doc_id too; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, kept, shrink
from tidemark.session import run_dir

RULES_VERSION = "2024-1"

# Kinds in order of listing, with the shape of each secret.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
FURTHER = (
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "PRIVATE KEY-----"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", "gh"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    ("google", r"AIza[A-Za-z0-9_-]{35}", "AIza"),
)
KINDS = ("assign", "access", "hex", *[k for k, _, _ in FURTHER])
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
_hex = re.compile(HEX)
_further = tuple((k, re.compile(p), gate) for k, p, gate in FURTHER)
LEDGER_SCHEMA = "digest binary, rules string, n_assign long, n_access long, n_hex long, base_spans string, all_spans string"


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings."""
    found = []
    lowered = text.lower()  # a gate only: it can let more through than the patterns match
    if any(k in lowered for k in KEYWORDS):
        found += [("assign", *m.span()) for m in _assign.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _access.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _hex.finditer(text)]
    for kind, pattern, gate in _further:
        if gate in text:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [hashlib.sha256(t.as_py().encode("utf-8", "surrogatepass")).digest() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "digest"])


def _scan(rules: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for digest, text in zip(batch.column("digest"), batch.column("text"), strict=True):
                spans = find_spans(text.as_py())
                base = [s for s in spans if s[0] in KINDS[:3]]
                n = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                out.append((digest.as_py(), rules, *n, _joined(base), _joined(spans)))
            names = ["digest", "rules", "n_assign", "n_access", "n_hex", "base_spans", "all_spans"]
            types = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return scan


def version_digests(docs: DataFrame) -> DataFrame:
    return documents(docs).mapInArrow(_digests, "doc_id long, digest binary")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was written there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def scan_unseen(docs: DataFrame, versions: DataFrame, ledger: DataFrame, rules: str) -> DataFrame:
    """Findings of the blobs among ``versions`` that ``ledger`` lacks under these rules."""
    seen = ledger.where(F.col("rules") == rules).select("digest")
    blobs = kept(
        versions.groupBy("digest")
        .agg(F.min("doc_id").alias("witness"), F.count(F.lit(1)).alias("n"))
        .join(seen, "digest", "left_anti"),
        "unseen",
    )
    texts = documents(docs)
    # Most contents occur once: it is cheaper to say which versions need no scan.
    spare = kept(versions.alias("v").join(blobs.alias("b"), (F.col("v.digest") == F.col("b.digest")) & F.col("v.doc_id").eqNullSafe(F.col("b.witness")), "left_anti").select("v.doc_id", "v.digest"), "spare")
    rows = spare.count()
    ids = spare.select(F.col("doc_id").alias("spare_id"), F.hex("digest").alias("spare_sha"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    todo = texts.withColumn("sha", sha).join(
        shrink(ids, rows), F.col("doc_id").eqNullSafe(F.col("spare_id")) & (F.upper("sha") == F.col("spare_sha")), "left_anti"
    )
    found = todo.select(F.unhex("sha").alias("digest"), "text").mapInArrow(_scan(rules), LEDGER_SCHEMA)
    return found.dropDuplicates(["digest"])


def scan(docs: DataFrame, ledger_path: str, rules: str = RULES_VERSION) -> DataFrame:
    """Findings of every version: doc_id, n_assign, n_access, n_hex, base_spans, spans.

    ``ledger_path`` is read first and appended to, so that a second run over the same contents scans
    nothing.
    """
    spark = docs.sparkSession
    versions = kept(version_digests(docs), "versions")
    scan_unseen(docs, versions, read_ledger(spark, ledger_path), rules).write.mode("append").parquet(ledger_path)
    known = read_ledger(spark, ledger_path).where(F.col("rules") == rules).dropDuplicates(["digest"])
    # Written first: a join on top of the grouping could not be split where one content has very many versions.
    hits = kept(known.where("all_spans <> ''"), "hits")
    rows = versions.join(hits, "digest", "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id",
        *[F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex")],
        F.coalesce("base_spans", F.lit("")).alias("base_spans"),
        F.coalesce("all_spans", F.lit("")).alias("spans"),
    )


def fresh_ledger(spark: SparkSession) -> str:
    return run_dir(spark, "ledger")
