"""Where working data goes: the shared folder the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the context's checkpoint folder, else one in the warehouse.

    All of these are shared by driver and executors; no setting of the session is changed.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = current.get() if current.isDefined() else None
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tidemark_work"
    return configured.rstrip("/")


def run_id() -> str:
    return uuid.uuid4().hex[:16]


def run_dir(spark: SparkSession, label: str, rid: str | None = None) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{label}-{rid or run_id()}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of working data; a missing one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
