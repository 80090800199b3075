"""Day to year: annual statistics, their trend and mean, and day-of-year normals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.functions.aggregates import annual_tag, annual_value, kind_aggregate, present

Period = tuple[int, int]

# The two periods whose normals are compared by default, both ends included.
NORMAL_PERIODS: tuple[Period, Period] = ((1960, 1989), (1990, 2019))

# Rows of a task that groups days or a stored state.
ROWS_PER_TASK = 500_000


def within_years(time: str, first: int, last: int) -> Column:
    """Whether a date or timestamp lies in the years first..last, written so that Parquet can skip row groups."""
    t = F.col(time)
    return (t >= F.lit(f"{first:04d}-01-01").cast("date")) & (t < F.lit(f"{last + 1:04d}-01-01").cast("date"))


def annual(daily: DataFrame, keys: Sequence[str], how: Sequence[str] = ("mean",)) -> DataFrame:
    """Annual statistics per key: any of mean, sum, min and max, as columns ``annual_<kind>``."""
    return daily.groupBy(*keys, F.year("time").alias("year")).agg(
        *[kind_aggregate(k, F.col("value")).alias(f"annual_{k}") for k in how]
    )


def annual_by_rule(daily: DataFrame, keys: Sequence[str], variable: str = "variable") -> DataFrame:
    """The annual value that each variable's name asks for, with its label ``tag``."""
    v = F.col(variable)
    grouped = daily.groupBy(variable, *keys, F.year("time").alias("year"))
    return grouped.agg(annual_value(v, F.col("value")).alias("value")).withColumn("tag", annual_tag(v))


def pivot_years(series: DataFrame, column: str, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per year and one column per name; the names are given, so no extra pass looks for them."""
    return series.groupBy(*keys, "year").pivot(column, list(names)).agg(F.first("value"))


def _line() -> dict[str, Column]:
    """The least-squares line through annual values as aggregates: needs two years with a value, else missing."""
    y, x = present(F.col("value")), F.col("year").cast("double")
    return {"years": F.regr_count(y, x), "slope": F.regr_slope(y, x), "intercept": F.regr_intercept(y, x), "mean": F.avg(y)}


def _guarded(lines: DataFrame) -> DataFrame:
    slope = F.when(F.col("years") >= 2, F.col("slope"))
    return lines.withColumns({
        "years": F.col("years").cast("int"),
        "slope": slope,
        "per_decade": slope * 10,
        "intercept": F.when(F.col("years") >= 2, F.col("intercept")),
    })


def trend(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The trend of each annual series, per year and per decade, and its long-term mean."""
    return _guarded(series.groupBy(*keys).agg(*[c.alias(n) for n, c in _line().items()]))


def with_fit(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every year of a series with the value of its trend line and the series' trend and mean.

    A group of the window holds one row per year.
    """
    group = Window.partitionBy(*keys)
    lines = series.withColumns({n: c.over(group) for n, c in _line().items()})
    return _guarded(lines).withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("year"))


def normals(daily: DataFrame, keys: Sequence[str], period: Period) -> DataFrame:
    """Mean by day of year over the years of a period; day 60 is 29 February in leap years."""
    return (
        daily.where(within_years("time", *period))
        .groupBy(*keys, F.dayofyear("time").alias("dayofyear"))
        .agg(F.avg(present(F.col("value"))).alias("normal"))
    )


def normals_two_periods(daily: DataFrame, keys: Sequence[str], periods: tuple[Period, Period] = NORMAL_PERIODS) -> DataFrame:
    """The normals of two periods side by side, from one pass over the days of either."""
    first, second = (within_years("time", *p) for p in periods)
    value = present(F.col("value"))
    return (
        daily.where(first | second)
        .groupBy(*keys, F.dayofyear("time").alias("dayofyear"))
        .agg(F.avg(F.when(first, value)).alias("normal_1"), F.avg(F.when(second, value)).alias("normal_2"))
    )


def _dealt(rows: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """``rows`` (``n`` of them) shuffled by key, about ``ROWS_PER_TASK`` to a task."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK)), *keys)


def normals_state(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What normals of any period can be made from: per key, day of year and year the sums of all years up to it.

    Columns: keys, ``dayofyear, year, total, n, days`` (sum and number of values, number of rows). A period is the
    difference of two years, so of a table partitioned by year only two are read for it, however long it is.
    Days hardly ever share a group, so they are shuffled as they are, once for the sums and the running sums: a task that
    reduced its rows before that would hold nearly all of them.
    """
    value = present(F.col("value"))
    last, n = daily.agg(F.max(F.year("time")), F.count(F.lit(1))).first()
    rows = daily.select(*keys, F.dayofyear("time").alias("dayofyear"), F.year("time").alias("year"), "value")
    sums = _dealt(rows, n, [*keys, "dayofyear"]).groupBy(*keys, "dayofyear", "year").agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"), F.count(value).alias("n"), F.count(F.lit(1)).alias("days")
    )
    # A group has one row per year.
    by_year = Window.partitionBy(*keys, "dayofyear").orderBy("year")
    until = F.lead("year").over(by_year) - 1
    summed = sums.select(*keys, "dayofyear", "year", until.alias("until"), *[F.sum(c).over(by_year).alias(c) for c in ("total", "n", "days")])
    # A year without data has the sums of the year before.
    years = F.explode(F.sequence("year", F.coalesce("until", F.lit(last))))
    return summed.withColumn("year", years).drop("until")


def write_normals_state(state: DataFrame, path: str) -> None:
    """By year, with as many files to a year as its size calls for (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    state.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(path)


def normals_from_state(state: DataFrame, keys: Sequence[str], periods: Sequence[Period]) -> DataFrame:
    """The normals ``normal_1, normal_2, ...`` of some periods from :func:`normals_state`; no day is read again.

    Days of year on which none of the periods has a row are left out, as by :func:`normals_two_periods`.
    """
    sizes = {r.year: r.n for r in state.groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}
    last = max(sizes, default=None)
    bounds = [(first - 1, min(end, last or end)) for first, end in periods]
    year = F.col("year")

    def between(column: str, before: int, end: int) -> Column:
        if end <= before:
            return F.lit(0)
        at = [F.coalesce(F.sum(F.when(year == y, F.col(column))), F.lit(0)) for y in (end, before)]
        return at[0] - at[1]

    # A group has one row per year, so rows are shuffled as they are.
    ends = sorted({y for b in bounds for y in b})
    rows = _dealt(state.where(year.isin(ends)), sum(sizes.get(y, 0) for y in ends), [*keys, "dayofyear"])
    found = rows.groupBy(*keys, "dayofyear").agg(
        *[between(c, *b).alias(f"{c}_{i}") for i, b in enumerate(bounds, 1) for c in ("total", "n", "days")]
    )
    some = reduce(lambda a, b: a | b, [F.col(f"days_{i}") > 0 for i in range(1, len(bounds) + 1)])
    mean = [F.when(F.col(f"n_{i}") > 0, F.col(f"total_{i}") / F.col(f"n_{i}")).alias(f"normal_{i}") for i in range(1, len(bounds) + 1)]
    return found.where(some).select(*keys, "dayofyear", *mean)
