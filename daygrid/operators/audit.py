"""Completeness and consistency of sets of files and units, as joins and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.sizing import stored

UNIT = ("variable", "year")


def work_list(variables: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Every (variable, year) that a request covers."""
    if first_year > last_year:
        return variables.select("variable").withColumn("year", F.lit(0)).limit(0)
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    return variables.select("variable").distinct().withColumn("year", years)


def missing_units(expected: DataFrame, existing: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Expected units without valid output."""
    return expected.join(existing.select(*keys), list(keys), "left_anti")


def present_units(expected: DataFrame, existing: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Expected units with valid output."""
    return expected.join(existing.select(*keys), list(keys), "left_semi")


def completion(expected: DataFrame, existing: DataFrame, by: Sequence[str] = (), keys: Sequence[str] = UNIT) -> DataFrame:
    """Expected, existing and missing units and the completion rate in percent; no expected units, no rate."""
    found = existing.select(*keys).distinct().withColumn("found", F.lit(1))
    joined = expected.join(found, list(keys), "left")
    counted = joined.groupBy(*by).agg(F.count(F.lit(1)).alias("expected"), F.count("found").alias("existing"))
    return counted.withColumns({
        "missing": F.col("expected") - F.col("existing"),
        "rate": F.try_divide(F.col("existing") * F.lit(100.0), F.col("expected")),
    })


def variable_sets(file_variables: DataFrame) -> DataFrame:
    """The sorted set of variables of each file.

    A set is as large as a file's header; rows are made distinct first, so that a
    file with many rows reaches its group as its few names.
    """
    return (
        file_variables.select("path", "variable")
        .distinct()
        .groupBy("path")
        .agg(F.array_sort(F.collect_set("variable")).alias("variables"))
    )


def set_groups(sets: DataFrame) -> DataFrame:
    """Each different variable set with its file count and an example file.

    The baseline is the set of the first file by path; ``is_baseline`` marks it. The groups are stored, so the sets are read once.
    """
    groups = stored(sets.groupBy("variables").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("example")), small=True)
    first = groups.agg(F.min("example")).first()[0]  # the first file is the first of its own group
    return groups.withColumn("is_baseline", F.col("example") == F.lit(first))


def compared_sets(sets: DataFrame) -> DataFrame:
    """Each file with whether its variable set is that of the first file by path.

    The sets are stored: they are read once to find the first and once to compare, and made once.
    """
    sets = stored(sets)
    baseline = sets.agg(F.min_by("variables", "path")).first()[0]
    same = F.lit(None).cast("boolean") if baseline is None else F.col("variables") == F.array(*map(F.lit, baseline)).cast("array<string>")
    return sets.withColumn("is_baseline", same)


def deviating_files(sets: DataFrame) -> DataFrame:
    """Files whose variable set is not that of the first file by path."""
    return compared_sets(sets).where(~F.col("is_baseline")).drop("is_baseline")


def consistency(sets: DataFrame) -> DataFrame:
    """Number of files and of different sets; consistent means exactly one set."""
    return sets.groupBy("variables").agg(F.count(F.lit(1)).alias("files")).agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.count(F.lit(1)).alias("variable_sets")
    ).withColumn("consistent", F.col("variable_sets") == 1)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def variables_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """A request's names as the one-column table that :func:`work_list` takes."""
    return spark.createDataFrame([(n,) for n in names], "variable string")
