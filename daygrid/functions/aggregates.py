"""Aggregate columns for one variable over one day (or year) of values.

Missing values arrive as NULL or NaN.  Spark's own aggregates skip NULL but not
NaN, so every builder starts from :func:`present`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daygrid.catalog import DailyVariable

AggregateBuilder = Callable[[Column], Column]


def present(value: Column) -> Column:
    """The value in double precision, with NaN as NULL."""
    v = value.cast("double")
    return F.nullif(v, F.lit(float("nan")))


def circular_mean(direction: Column) -> Column:
    """Mean direction in degrees, in [0, 360), every hour counting the same."""
    angle = F.radians(present(direction))
    mean_angle = F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle)))
    return (F.degrees(mean_angle) + F.lit(360.0)) % F.lit(360.0)


def total(value: Column) -> Column:
    """Sum that is 0, not missing, when a group has rows but no present value."""
    return F.coalesce(F.sum(present(value)), F.lit(0.0))


KINDS: dict[str, AggregateBuilder] = {
    "mean": lambda v: F.avg(present(v)),
    "min": lambda v: F.min(present(v)),
    "max": lambda v: F.max(present(v)),
    "sum": total,
    "circular_mean": circular_mean,
}


def kind_aggregate(kind: str, value: Column, kinds: dict[str, AggregateBuilder] | None = None) -> Column:
    """The aggregate column of a kind.

    ``kinds`` adds or replaces builders: any function from a value column to an
    aggregate column, a grouped-aggregate pandas UDF included.
    """
    builders = {**KINDS, **(kinds or {})}
    if kind not in builders:
        raise ValueError(f"no aggregate builder for kind {kind!r}")
    return builders[kind](value)


def daily_aggregate(entry: DailyVariable, value: Column, kinds: dict[str, AggregateBuilder] | None = None) -> Column:
    """The aggregate column of a catalogue entry, its shift included."""
    result = kind_aggregate(entry.agg_kind, value, kinds)
    return result + F.lit(entry.offset) if entry.offset else result


# How a daily variable is reduced to a year, by what its name contains; the first match decides.
ANNUAL_RULES = [
    ("sum", "sum", "Total Annual"),
    ("rain", "sum", "Total Annual"),
    ("min", "mean", "Mean Annual Daily Minimum"),
    ("max", "mean", "Mean Annual Daily Maximum"),
    ("", "mean", "Mean Annual"),
]


def annual_tag(variable: Column) -> Column:
    """Label of the annual statistic that a variable gets."""
    return F.coalesce(*[F.when(variable.contains(part), F.lit(tag)) for part, _, tag in ANNUAL_RULES])


def annual_value(variable: Column, value: Column) -> Column:
    """Aggregate column that follows the annual rule; ``variable`` must be constant within the group."""
    summed = F.coalesce(*[F.when(variable.contains(part), F.lit(how == "sum")) for part, how, _ in ANNUAL_RULES])
    return F.when(summed, total(value)).otherwise(F.avg(present(value)))
