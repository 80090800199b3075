"""Decisions that depend on how big something is: broadcasts and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table, in rows, that is sent whole to every executor (a few dozen bytes per row).
BROADCAST_ROWS = 1_000_000

_handed_out: list[str] = []


def row_bound(df: DataFrame, limit: int = BROADCAST_ROWS) -> int | None:
    """The row count of ``df`` if it is at most ``limit``, else None."""
    n = df.count()
    return n if n <= limit else None


def broadcast_within(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast when its proven row bound allows it, else ``df`` as it is.

    Without the mark Spark plans a shuffle join, and adaptive execution splits
    its skewed partitions.
    """
    return F.broadcast(df) if rows is not None and rows <= limit else df


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="run-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables that every executor can reach.

    It lies under ``spark.checkpoint.dir``, or the context's checkpoint folder.
    Only a local session, whose executors share the driver's disk, may go
    without; its folder goes when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _own_folder().name
    _handed_out.append(f"{root.rstrip('/')}/daygrid-{uuid.uuid4().hex}")
    return _handed_out[-1]


def remove_stored(spark: SparkSession) -> None:
    """Remove every folder that :func:`shared_folder` has handed out; results that still read them must have been used."""
    while _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, small: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe when executors are lost.

    With ``small`` one file per core is written. Each task then works through its share of the partitions one
    after another, so it needs no more memory; that suits tables that are small beside the input.
    """
    path = shared_folder(df.sparkSession)
    if small:
        df = df.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
