"""Session settings that suit the package's jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar days of source data have no time zone.
    "spark.sql.session.timeZone": "UTC",
    # Run-time partition coalescing and skew splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split that holds whole days lets the hours of a cell combine before the shuffle.
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes a product keeps a file open for each of up to so many outputs instead of sorting by output.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
