"""Checks of the files and units of a production run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.operators.audit import completion, consistency, missing_units, set_groups, variables_frame, work_list
from daygrid.sources.files import read_headers, readable
from daygrid.sources.logs import read_logs, retry_list, timed_out
from daygrid.sources.product import committed_units


def readability(spark: SparkSession, folder: str, variables: Sequence[str] | None = None) -> DataFrame:
    """Every Parquet file under a folder, or only those of some variables of a product, with whether it opens."""
    files = readable(spark, folder)
    if variables is not None:
        files = files.where(F.regexp_extract("path", "/variable=([^/]+)/", 1).isin(list(variables)))
    return files


def header_sets(headers: DataFrame, coordinates: Sequence[str] = ()) -> DataFrame:
    """The sorted variable set of each file that opened, without coordinate columns."""
    names = F.array_except("variables", F.array(*[F.lit(c) for c in coordinates]).cast("array<string>"))
    return headers.where("opened").select("path", F.array_sort(names).alias("variables"))


def schema_consistency(spark: SparkSession, folder: str, coordinates: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Summary and groups of the variable sets of all files; files that do not open are counted, not grouped."""
    headers = read_headers(spark, folder)
    sets = header_sets(headers, coordinates)
    failed = headers.agg(F.count_if(~F.col("opened")))
    summary = consistency(sets).withColumn("files_failed", failed.scalar())
    return summary, set_groups(sets)


def completeness(spark: SparkSession, root: str, variables: Sequence[str], first_year: int, last_year: int) -> tuple[DataFrame, DataFrame]:
    """Completion numbers of a request against the manifest of a product, and its missing units."""
    expected = work_list(variables_frame(spark, variables), first_year, last_year)
    existing = committed_units(spark, root)
    return completion(expected, existing), missing_units(expected, existing)


def timed_out_units(spark: SparkSession, folder: str, requested: DataFrame | None = None) -> DataFrame:
    """Units whose log shows a timeout; with a request, only those of the request."""
    found = timed_out(read_logs(spark, folder))
    return found.select("variable", "year").distinct() if requested is None else retry_list(found, requested)
