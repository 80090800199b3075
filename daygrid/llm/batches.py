"""How much text a Python worker gets at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Bytes of a batch of rows (a longer row alone).
BATCH_BYTES = 4 << 20

_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(rows: DataFrame) -> DataFrame:
    """``rows`` as they are; batches for Python are bounded to ``BATCH_BYTES`` in their session.

    By Spark's own limit (64 MB or 10,000 rows) a task holds several times that much on both sides of the pipe, since
    buffers double as they grow. The limit is read when a job starts, so the session keeps it; a lower one stays.
    """
    conf = rows.sparkSession.conf
    # Spark prints the limit it starts with in bytes.
    if _bytes(conf.get(_LIMIT)) > BATCH_BYTES:
        conf.set(_LIMIT, str(BATCH_BYTES))
    return rows


def _bytes(size: str) -> int:
    number, unit = size.lower().rstrip("b"), 1
    if number[-1] in "kmgt":
        unit, number = 1024 ** (1 + "kmgt".index(number[-1])), number[:-1]
    return int(number) * unit
