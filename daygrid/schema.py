"""Schemas of the tables, so that readers need not look into files to learn them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from daygrid.catalog import CATALOG, source_variables


def hourly_schema(names: Iterable[str] | None = None, levels: bool = True) -> T.StructType:
    """Hourly source with the source variables that some outputs need (all by default).

    A variable that a file lacks reads as missing.
    """
    fields = [T.StructField("time", T.TimestampNTZType(), False)]
    if levels:
        fields.append(T.StructField("level", T.IntegerType()))
    fields += [T.StructField(c, T.IntegerType(), False) for c in ("south_north", "west_east")]
    fields += [T.StructField(v, T.DoubleType()) for v in source_variables(CATALOG if names is None else names)]
    return T.StructType([*fields, T.StructField("year", T.IntegerType())])


PRODUCT = T.StructType([
    T.StructField("time", T.DateType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("y_idx", T.IntegerType()),
    T.StructField("x_idx", T.IntegerType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("variable", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

ATTRIBUTES = T.StructType([
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("variable", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

MANIFEST = T.StructType([
    T.StructField("variable", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("commit", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("sequence", T.LongType()),
])
