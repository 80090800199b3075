"""Hourly source data: Parquet tables partitioned by ``year``, one column per source variable."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrid.catalog import DailyVariable, source_variables
from daygrid.operators.audit import duplicate_keys
from daygrid.operators.daily import CELL
from daygrid.sizing import broadcast_within, row_bound, stored

# So many overlapping files are named in the scan's filter, which then opens no others.
FEW_FILES = 1000


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_years(
    spark: SparkSession, root: str, first_year: int, last_year: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """The hourly rows of one year or a run of years; a missing folder or year is an error.

    Without a schema (see :mod:`daygrid.schema`) that of one file is taken.
    """
    last_year = first_year if last_year is None else last_year
    table = read_table(spark, root, schema)
    if table is None:
        raise FileNotFoundError(f"no hourly data at {root}")
    return require_years(table, first_year, last_year)


def _files_by_year(table: DataFrame) -> dict[int, str]:
    """One file of each year, from the list of the table's files; empty where folders do not tell the year."""
    return {int(m[1]): f for f in table.inputFiles() if (m := re.search(r"/year=(\d+)/", f))}


def require_years(table: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """The rows of years first..last; a year without rows is an error.

    Where the table is partitioned by year, the list of its files tells; no file is opened.
    """
    rows = table.where(F.col("year").between(first_year, last_year))
    found = set(_files_by_year(table)) or {r.year for r in rows.select("year").distinct().collect()}
    absent = [y for y in range(first_year, last_year + 1) if y not in found]
    if absent:
        raise FileNotFoundError(f"no hourly data for the years {absent}")
    return rows


def require_columns(table: DataFrame, columns: Sequence[str], first_year: int, last_year: int) -> None:
    """Fail if the files of a year lack a source variable, which would otherwise read as missing and sum to 0.

    All files of a year are taken to have the columns of one: one footer per year is opened.
    """
    absent = sorted(set(columns) - set(table.columns))
    if absent:
        raise ValueError(f"hourly data lacks the source variables {absent}")
    for year, file in sorted(_files_by_year(table).items()):
        if first_year <= year <= last_year:
            absent = sorted(set(columns) - set(table.sparkSession.read.parquet(file).columns))
            if absent:
                raise ValueError(f"hourly data of {year} lacks the source variables {absent}")


def for_outputs(hourly: DataFrame, names: Iterable[str | DailyVariable], cell: Sequence[str] = CELL) -> DataFrame:
    """Only the columns that the requested outputs need, so that the scan reads no others."""
    keys = [c for c in ("time", "level", *cell, "year") if c in hourly.columns]
    return hourly.select(*keys, *source_variables(names))


def append_in_time(parts: Sequence[DataFrame]) -> DataFrame:
    """Batches of the same grid as one table; a variable that a batch lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def overlapping_files(hourly: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """Pairs ``first, second`` of files of which some hours and some cells are common to both, by their extents.

    ``hourly`` is a table as read from files. Each file is reduced to its first and last hour and its first and last row and column, which
    needs one shuffled row per file and task. Extents meet by day and by squares as wide as the widest file, so files
    are compared only with those near them in time and place.
    """
    ends = [f(c).alias(f"{c}_{n}") for c in ("time", *cell) for f, n in ((F.min, "low"), (F.max, "high"))]
    files = stored(hourly.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends), small=True)
    widest = files.agg(*[F.max(F.col(f"{c}_high") - F.col(f"{c}_low") + 1).alias(c) for c in cell]).first()
    placed = files.withColumn("day", F.explode(F.sequence(F.to_date("time_low"), F.to_date("time_high"))))
    for c in cell:
        number = lambda end: F.floor(F.col(f"{c}_{end}") / F.lit(widest[c] or 1)).cast("bigint")  # noqa: B023, E731
        placed = placed.withColumn(f"{c}_square", F.explode(F.sequence(number("low"), number("high"))))
    meet = ["day", *[f"{c}_square" for c in cell]]
    other = placed.select(*meet, *[F.col(c).alias(f"other_{c}") for c in files.columns])
    common = F.col("file") < F.col("other_file")
    for c in ("time", *cell):
        common = common & (F.col(f"{c}_low") <= F.col(f"other_{c}_high")) & (F.col(f"other_{c}_low") <= F.col(f"{c}_high"))
    return placed.join(other, meet).where(common).select(F.col("file").alias("first"), F.col("other_file").alias("second")).distinct()


def overlapping_hours(hourly: DataFrame, cell: Sequence[str] = CELL, within_files: bool = False) -> DataFrame:
    """Audit of an append: hours that a cell has more than once.

    Of a table read from files only those are compared hour by hour that overlap another by their extents; where none does, no hour is
    shuffled. A file is taken to hold an hour once; ``within_files`` compares all rows of all files, as is
    done for a table that does not come from files.
    """
    keys = [c for c in ("time", "level", *cell, "var_id") if c in hourly.columns]
    if within_files or not _has_files(hourly):
        return duplicate_keys(hourly, keys)
    pairs = stored(overlapping_files(hourly, cell), small=True)
    files = pairs.select(F.col("first").alias("file")).union(pairs.select("second")).distinct()
    bound = row_bound(files)
    if bound == 0:
        return duplicate_keys(hourly.limit(0), keys)
    path = F.col("_metadata.file_path")
    if bound <= FEW_FILES:
        return duplicate_keys(hourly.where(path.isin([r.file for r in files.collect()])), keys)
    return duplicate_keys(hourly.withColumn("file", path).join(broadcast_within(files, bound), "file", "left_semi"), keys)


def _has_files(table: DataFrame) -> bool:
    try:
        table.select("_metadata.file_path")
    except AnalysisException:
        return False
    return True
