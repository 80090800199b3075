"""Hour to day: every requested output of every cell in one aggregation.

Both entry points group by calendar day, cell and level.  The aggregates are
algebraic, so each task first reduces its own rows; what is shuffled is one
partial row per task, day and cell, however unevenly rows are spread.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.catalog import DailyVariable, resolve
from daygrid.functions.aggregates import AggregateBuilder, daily_aggregate, kind_aggregate

CELL = ("south_north", "west_east")


def day_of(time: str) -> Column:
    """Calendar day of a timestamp without time zone."""
    return F.to_date(F.col(time))


def daily_wide(
    hourly: DataFrame,
    names: Iterable[str | DailyVariable],
    *,
    cell: Sequence[str] = CELL,
    time: str = "time",
    kinds: dict[str, AggregateBuilder] | None = None,
) -> DataFrame:
    """Daily outputs as columns, from a table with one column per source variable.

    A source column is read once however many outputs it feeds.  If all outputs
    have a level dimension, or none has, rows of the other sort are not read.
    """
    entries = resolve(names)
    hourly = relevant_rows(hourly, entries)
    missing = sorted({e.var_id for e in entries} - set(hourly.columns))
    if missing:
        raise ValueError(f"hourly data lacks the source variables {missing}")
    keys = [*cell, *(["level"] if "level" in hourly.columns else [])]
    return hourly.groupBy(day_of(time).alias("time"), *keys).agg(
        *[daily_aggregate(e, F.col(e.var_id), kinds).alias(e.name) for e in entries]
    )


def relevant_rows(hourly: DataFrame, entries: Sequence[DailyVariable]) -> DataFrame:
    """The rows that can hold values of the outputs: with a level, without, or all."""
    dims = {e.dims for e in entries}
    if "level" not in hourly.columns or len(dims) > 1:
        return hourly
    return hourly.where(F.col("level").isNull() if dims == {2} else F.col("level").isNotNull())


def output_groups(hourly: DataFrame, names: Iterable[str | DailyVariable]) -> list[list[DailyVariable]]:
    """The outputs to be made together: those with and those without a level live on different rows."""
    entries = resolve(names)
    if "level" not in hourly.columns:
        return [entries]
    return [group for d in (2, 3) if (group := [e for e in entries if e.dims == d])]


def daily_outputs(hourly: DataFrame, names: Iterable[str | DailyVariable], **options) -> DataFrame:
    """Daily outputs as rows ``(variable, value)``, from a table with one column per source variable.

    One aggregation makes all outputs that live on the same rows; the two
    sorts share no source column, so nothing but the keys is read twice.
    """
    parts = [to_long(daily_wide(hourly, group, **options), group) for group in output_groups(hourly, names)]
    return reduce(DataFrame.unionByName, parts)


def to_long(wide: DataFrame, names: Iterable[str | DailyVariable]) -> DataFrame:
    """Output columns as rows ``(variable, value)``.

    Where the table has a level, outputs with a level dimension keep the rows
    that have one and the other outputs keep the rows that have none.
    """
    entries = resolve(names)
    outputs = [e.name for e in entries]
    ids = [c for c in wide.columns if c not in outputs]
    long = wide.unpivot(ids, outputs, "variable", "value")
    if "level" not in ids:
        return long
    levelled = [e.name for e in entries if e.dims == 3]
    return long.where(F.col("level").isNotNull() == F.col("variable").isin(levelled))


def daily_long(
    observations: DataFrame,
    names: Iterable[str | DailyVariable],
    *,
    cell: Sequence[str] = CELL,
    time: str = "time",
    kinds: dict[str, AggregateBuilder] | None = None,
) -> DataFrame:
    """Daily outputs as rows, from a table of rows ``(time, cell, var_id, value)``.

    Each statistic is computed once per source variable; the outputs that
    share it are told apart afterwards.
    """
    entries = resolve(names)
    keys = [*cell, *(["level"] if "level" in observations.columns else [])]
    wanted = sorted({e.agg_kind for e in entries})
    value = F.col("value")
    # A kind sees the rows of those variables only that want it; the others cost it nothing.
    of_kind = {k: sorted({e.var_id for e in entries if e.agg_kind == k}) for k in wanted}
    stats = (
        observations.where(F.col("var_id").isin(sorted({e.var_id for e in entries})))
        .groupBy("var_id", day_of(time).alias("time"), *keys)
        .agg(*[kind_aggregate(k, F.when(F.col("var_id").isin(of_kind[k]), value), kinds).alias(f"stat_{k}") for k in wanted])
    )

    def outputs_of(var_id: str) -> Column:
        return F.array(*[
            F.struct(F.lit(e.name).alias("variable"), (F.col(f"stat_{e.agg_kind}") + F.lit(e.offset)).alias("value"))
            for e in entries
            if e.var_id == var_id
        ])

    per_source = F.coalesce(*[F.when(F.col("var_id") == v, outputs_of(v)) for v in sorted({e.var_id for e in entries})])
    return stats.select("time", *keys, F.inline(per_source))


def complete_days(
    daily: DataFrame,
    cell: Sequence[str] = CELL,
    *,
    span: tuple[date, date] | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Add rows with missing values so that every cell has every day between the first and the last.

    The day axis is common to all cells, as it is for an array.  ``span`` and
    ``cells`` (the distinct keys) are read from ``daily`` unless they are given;
    a caller that knows them from the grid and the time axis saves two passes.
    """
    keys = [c for c in (*cell, "level", "variable") if c in daily.columns]
    values = [c for c in daily.columns if c not in (*keys, "time")]
    if span is None:
        span = tuple(daily.agg(F.min("time"), F.max("time")).first())
    if span[0] is None:
        return daily
    days = F.explode(F.sequence(F.lit(span[0]), F.lit(span[1]))).alias("time")
    cells = daily.select(*keys).distinct() if cells is None else cells
    frame = cells.select(*keys, days).alias("frame")
    data = daily.alias("data")
    same = F.col("frame.time") == F.col("data.time")
    for k in keys:
        same = same & F.col(f"frame.{k}").eqNullSafe(F.col(f"data.{k}"))
    return frame.join(data, same, "left").select(
        "frame.time", *[f"frame.{k}" for k in keys], *[f"data.{v}" for v in values]
    )


@dataclass(frozen=True)
class TimeAxis:
    """The calendar of a table: its days, and its levels (None for rows without a level)."""

    days: tuple[date, ...]
    levels: tuple[int | None, ...]

    @property
    def every_day(self) -> list[date]:
        """All days between the first and the last of each year."""
        return [date.fromordinal(k) for a, b in self.spans for k in range(a.toordinal(), b.toordinal() + 1)]

    @property
    def spans(self) -> list[tuple[date, date]]:
        """First and last day of each year."""
        years = sorted({d.year for d in self.days})
        return [(min(d for d in self.days if d.year == y), max(d for d in self.days if d.year == y)) for y in years]


def time_axis(daily: DataFrame, time: str = "time") -> TimeAxis:
    """The calendar of a table, from its time and level columns only; best read from daily rows, which are fewest.

    The sets are as long as the calendar and the list of levels, whatever the number of rows.
    """
    level = F.col("level") if "level" in daily.columns else F.lit(None).cast("int")
    row = daily.agg(
        F.collect_set(day_of(time)).alias("days"), F.collect_set(level).alias("levels"),
        F.bool_or(level.isNull()).alias("flat"),
    ).first()
    return TimeAxis(tuple(sorted(row.days)), ((None,) if row.flat else ()) + tuple(sorted(row.levels)))
