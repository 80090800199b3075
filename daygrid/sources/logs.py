"""Job logs: text files named after the unit they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The name of a log file and the two phrases that a timeout leaves in it.
LOG_GLOB = "era5_*.out"
LOG_NAME = r"era5_(.+)_(\d{4})\.out"
TIMEOUT_PHRASES = ("CANCELLED AT", "DUE TO TIME LIMIT")


def read_logs(spark: SparkSession, folder: str, glob: str = LOG_GLOB) -> DataFrame:
    """Lines of all logs under a folder as ``(path, content)``; files that cannot be read are skipped.

    A log is read line by line and not as one value, so a huge log is split
    like any other file.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .text(folder)
    )
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def units_of(logs: DataFrame, pattern: str = LOG_NAME) -> DataFrame:
    """Attach ``variable`` and ``year`` parsed from the path; rows whose path does not match are dropped."""
    return logs.withColumns({
        "variable": F.regexp_extract("path", pattern, 1),
        "year": F.regexp_extract("path", pattern, 2).try_cast("bigint"),
    }).where((F.col("variable") != "") & F.col("year").isNotNull())


def contains_all(content: Column, phrases: tuple[str, ...]) -> Column:
    """Whether a text contains every phrase."""
    result = content.contains(phrases[0])
    for p in phrases[1:]:
        result = result & content.contains(p)
    return result


def timed_out(logs: DataFrame, pattern: str = LOG_NAME, phrases: tuple[str, ...] = TIMEOUT_PHRASES) -> DataFrame:
    """Units whose log contains every phrase, on whichever lines.

    A log is reduced by flags that combine before the shuffle, so its length
    does not matter.
    """
    flags = [F.bool_or(F.col("content").contains(p)).alias(f"has_{i}") for i, p in enumerate(phrases)]
    seen = units_of(logs, pattern).groupBy("path", "variable", "year").agg(*flags)
    for i in range(len(phrases)):
        seen = seen.where(F.col(f"has_{i}"))
    return seen.select("path", "variable", "year")


def retry_list(timeouts: DataFrame, requested: DataFrame) -> DataFrame:
    """Timed-out units of a request, each once, to be run again."""
    return timeouts.select("variable", "year").distinct().join(requested, ["variable", "year"], "left_semi")
