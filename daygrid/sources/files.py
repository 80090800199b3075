"""File headers: whether each Parquet file opens, and which variables it holds."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.sizing import shared_folder

# Footers that are opened at a time, and files whose headers are written together.
JOBS, BATCH = 32, 4096

HEADERS = "path string, opened boolean, error string, variables array<string>"


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """Paths and sizes of all matching files under a folder; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", "length")
    )


def readable(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """``path, opened, rows`` of every file under a folder; a file without rows counts as not opened.

    Spark's own reader opens the footers, spread over tasks, so any path and store that it
    knows will do; files that it cannot open it leaves out.
    """
    listed = list_files(spark, folder, glob).select("path")
    # Which columns there are does not matter, none is read.
    files = (
        spark.read.schema("_none int").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .option("ignoreCorruptFiles", True).parquet(folder)
    )
    place = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), "[+]", "%2B"))
    seen = files.groupBy(_plain(place).alias("place")).agg(F.count(F.lit(1)).alias("rows"))
    joined = listed.withColumn("place", _plain(F.col("path"))).join(seen, "place", "left")
    return joined.select("path", F.col("rows").isNotNull().alias("opened"), "rows")


def _plain(path: Column) -> Column:
    """One spelling of a path: a local one is written with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read_headers(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """The columns of every file under a folder; a file that does not open is a row with its error.

    Spark's reader opens each footer in a job of its own on an executor, ``JOBS`` of them at a time. The rows are written in
    batches of ``BATCH`` files, so that the driver holds the headers of one batch, however many files there are.
    """
    path = shared_folder(spark)
    spark.createDataFrame([], HEADERS).write.mode("append").parquet(path)
    names = (r["path"] for r in list_files(spark, folder, glob).select("path").toLocalIterator())
    with ThreadPoolExecutor(JOBS) as pool:
        while batch := list(islice(names, BATCH)):
            rows = list(pool.map(lambda name: _header(spark, name), batch))
            spark.createDataFrame(rows, HEADERS).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(HEADERS).parquet(path)


def _header(spark: SparkSession, path: str) -> tuple[str, bool, str | None, list[str] | None]:
    try:
        return path, True, None, spark.read.parquet(_literal(path)).columns
    except (PySparkException, Py4JJavaError) as e:
        return path, False, str(e).splitlines()[0], None


def _literal(path: str) -> str:
    """A path for the reader, which takes some characters for patterns."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)
