"""Reprojection of daily fields to the target grid, nearest neighbour.

Which source cell feeds a target cell depends on the two grids only.  The map is
computed from the cell number by Column arithmetic, without reading any data,
and joined to the daily fields by source cell.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.projections import ALASKA_ALBERS, SOURCE_PLANE
from daygrid.grids import Grid, grid_cells
from daygrid.operators.cell_join import join_cells
from daygrid.operators.daily import CELL, TimeAxis
from daygrid.sizing import BROADCAST_ROWS, stored

EPOCH = date(1970, 1, 1).toordinal()

# A task generates at most about this many rows of missing values.
ROWS_PER_TASK = 2_000_000


def regrid_map(
    spark: SparkSession, source: Grid, target: Grid, source_plane=SOURCE_PLANE, target_plane=ALASKA_ALBERS
) -> DataFrame:
    """Target cells with the source cell that holds their centre: NULL indices outside the source domain."""
    cells = grid_cells(spark, target)
    lon, lat = target_plane.inverse(F.col("x"), F.col("y"))
    cells = cells.withColumns({"lon": lon, "lat": lat})
    sx, sy = source_plane.forward(F.col("lon"), F.col("lat"))
    cells = cells.withColumns({"sx": sx, "sy": sy})
    cells = cells.withColumns({"row": source.y.containing(F.col("sy")), "column": source.x.containing(F.col("sx"))})
    inside = F.col("row").isNotNull() & F.col("column").isNotNull()
    return cells.select(
        "y_idx", "x_idx", "y", "x",
        F.when(inside, F.col("row")).alias("south_north"),
        F.when(inside, F.col("column")).alias("west_east"),
    )


def stored_regrid_map(
    spark: SparkSession, source: Grid, target: Grid, source_plane=SOURCE_PLANE, target_plane=ALASKA_ALBERS
) -> DataFrame:
    """:func:`regrid_map`, written once and read back.

    The map depends on neither time nor variable.  Stored, it is a small table
    with known size; left as an expression, the filters that joins imply would
    repeat the projection formulas in the join's plan.
    """
    return stored(regrid_map(spark, source, target, source_plane, target_plane))


def regrid(daily: DataFrame, grid_map: DataFrame, target_cells: int, **join) -> DataFrame:
    """Daily fields on the target cells that lie in the source domain; every other column is carried along.

    ``target_cells`` is the size of ``grid_map``, known from the target grid;
    ``join`` are the options of :func:`~daygrid.operators.cell_join.join_cells`.
    """
    keys = ["south_north", "west_east"]
    cells = grid_map.where(F.col("south_north").isNotNull())
    return join_cells(daily, cells, keys, target_cells, **join).drop(*keys)


def full_cube(
    daily: DataFrame, grid_map: DataFrame, target_cells: int, axis: TimeAxis, *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Every target cell on every day of ``axis`` and at every level, with the daily fields of its source cell.

    Columns: ``y_idx, x_idx, y, x, time, level`` and the values of ``daily``, which are missing
    outside the source domain, on days without data, and wherever the source has no
    row for the cell.  Only what is absent is generated.  The rows of each day are counted first, in cells that feed a
    target cell; a day that has all of them at all levels goes through the map as it is.  A
    day without any gets a row for each of these source cells, and of the other days those that they lack, found by an
    anti-join of these days alone or, if they are many, by cell as the difference of two lists of days.  Cells outside the domain are generated and need no join.
    ``daily`` is read three times, so it should be stored; with a map that may be broadcast, dense data are not shuffled.
    """
    feeding = grid_map.where(F.col("south_north").isNotNull()).select(*CELL).distinct()
    feeding = stored(feeding, small=True)
    used = feeding.count()
    have = covered_days(daily, feeding, used, broadcast_rows)
    days = axis.every_day
    # Days of data that the axis leaves out have no place in the cube.
    inside = daily if set(have) <= set(days) else daily.where(F.col("time").isin(days))
    whole = used * len(axis.levels)
    empty = [d for d in days if whole and not have.get(d)]
    partial = [d for d in days if 0 < have.get(d, 0) < whole]
    parts = [inside]
    if empty:
        parts.append(_frame(feeding, used, empty, axis.levels))
    if partial:
        present = inside.where(F.col("time").isin(partial)) if len(partial) < len(days) else inside
        lacking = _absent if whole * len(partial) > ROWS_PER_TASK else _absent_of_few
        parts.append(lacking(present, feeding, used, partial, axis.levels))
    complete = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in daily.columns if c not in (*CELL, "time", "level")]
    place = ["y_idx", "x_idx", "y", "x", "time", "level"]
    cube = regrid(complete, grid_map, target_cells, broadcast_rows=broadcast_rows).select(*place, *values)
    outside = grid_map.where(F.col("south_north").isNull())
    return cube.unionByName(_frame(outside, target_cells, days, axis.levels).select(*place), allowMissingColumns=True)


def covered_days(daily: DataFrame, cells: DataFrame, rows: int, broadcast_rows: int = BROADCAST_ROWS) -> dict[date, int]:
    """For each day of ``daily`` how many of its rows lie in ``cells`` (of ``rows`` rows); as many entries as days."""
    inside = join_cells(daily.select("time", *CELL), cells, CELL, rows, broadcast_rows=broadcast_rows)
    counts = inside.groupBy("time").agg(F.count(F.lit(1)).alias("n"))
    every = daily.groupBy("time").agg(F.lit(0).cast("bigint").alias("n"))
    return {r.time: r.n for r in counts.unionByName(every).groupBy("time").agg(F.sum("n").alias("n")).collect()}


def _frame(cells: DataFrame, rows: int, days: Sequence[date], levels: Sequence[int | None]) -> DataFrame:
    """``cells`` on every one of ``days`` and ``levels``, spread over as many tasks as the rows call for."""
    tasks = math.ceil(rows * len(days) * len(levels) / ROWS_PER_TASK)
    if tasks > 1:
        cells = cells.repartition(tasks, *[c for c in ("y_idx", "x_idx", *CELL) if c in cells.columns][:2])
    dated = cells.withColumn("time", F.explode(_numbers(days))).withColumn("time", F.date_from_unix_date("time"))
    return dated.withColumn("level", _each(levels))


def _absent(present: DataFrame, cells: DataFrame, rows: int, days: Sequence[date], levels: Sequence[int | None]) -> DataFrame:
    """The days that each of ``cells`` (of ``rows`` rows) lacks at each level; a row of the join holds a list as long as the calendar."""
    tasks = math.ceil(rows * len(days) * len(levels) / ROWS_PER_TASK)
    have = present.groupBy(*CELL, "level").agg(F.collect_set(F.unix_date("time")).alias("have")).alias("present")
    wanted = cells.withColumn("level", _each(levels)).alias("wanted")
    same = F.col("wanted.level").eqNullSafe(F.col("present.level"))
    for key in CELL:
        same = same & (F.col(f"wanted.{key}") == F.col(f"present.{key}"))
    both = wanted.join(have, same, "left").select(*[F.col(f"wanted.{c}") for c in (*CELL, "level")], "have")
    if tasks > 1:
        both = both.repartition(tasks, *CELL)
    numbers = _numbers(days)
    lacking = F.when(F.col("have").isNull(), numbers).otherwise(F.array_except(numbers, "have"))
    return both.select(*CELL, "level", F.explode(lacking).alias("time")).withColumn("time", F.date_from_unix_date("time"))


def _absent_of_few(present: DataFrame, cells: DataFrame, rows: int, days: Sequence[date], levels: Sequence[int | None]) -> DataFrame:
    """:func:`_absent` by an anti-join, for days whose rows one task can generate."""
    frame = _frame(cells, rows, days, levels).alias("frame")
    own = present.select("time", "level", *CELL).alias("present")
    same = F.col("frame.level").eqNullSafe(F.col("present.level"))
    for key in (*CELL, "time"):
        same = same & (F.col(f"frame.{key}") == F.col(f"present.{key}"))
    return frame.join(own, same, "left_anti")


def _numbers(days: Sequence[date]) -> Column:
    return F.split(F.lit(",".join(str(d.toordinal() - EPOCH) for d in days)), ",").cast("array<int>")


def _each(levels: Sequence[int | None]) -> Column:
    return F.explode(F.array(*[F.lit(n).cast("int") for n in levels]))
