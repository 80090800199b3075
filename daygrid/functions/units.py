"""Temperature units as they are found in source and product attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daygrid.catalog import KELVIN_SHIFT

# Accepted spellings, compared without regard to case.
KELVIN_NAMES = ["K", "KELVIN"]
CELSIUS_NAMES = ["degree_c", "degc", "celsius", "c", "degrees_celsius"]


def celsius_shift(units: Column, default: str) -> Column:
    """Number to add to a temperature to get degrees Celsius.

    ``default`` says what an absent or unknown unit means: ``'kelvin'`` for
    source fields, ``'unchanged'`` for product fields.
    """
    if default not in ("kelvin", "unchanged"):
        raise ValueError(f"default must be 'kelvin' or 'unchanged', not {default!r}")
    fallback = KELVIN_SHIFT if default == "kelvin" else 0.0
    return (
        F.when(F.upper(units).isin(KELVIN_NAMES), F.lit(KELVIN_SHIFT))
        .when(F.lower(units).isin(CELSIUS_NAMES), F.lit(0.0))
        .otherwise(F.lit(fallback))
    )


def to_celsius(value: Column, units: Column, default: str) -> Column:
    return value + celsius_shift(units, default)
