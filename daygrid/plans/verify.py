"""Does the product say what the source says?  Checked at named places, allowing for a shift of one cell."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.aggregates import present
from daygrid.functions.projections import planar_km, sphere_km
from daygrid.functions.units import celsius_shift
from daygrid.grids import Grid
from daygrid.operators.cell_join import join_cells
from daygrid.operators.compare import best_offset, mean_abs_difference
from daygrid.operators.daily import CELL, day_of
from daygrid.operators.nearest import nearest_cells, nearest_on_grid, neighbourhood
from daygrid.plans.points import near_cells, projected
from daygrid.sizing import broadcast_within, row_bound, stored


# At which coordinates the product is read: those of the place's source cell, and the place's own.
KINDS = ("exact", "community")


def assemble(tables: Sequence[DataFrame], on: str = "name") -> DataFrame:
    """Tables of the same places side by side; a place that one table lacks is missing there."""
    return reduce(lambda a, b: a.join(b, on, "full_outer"), tables)


def coordinate_report(points: DataFrame, src_grid: DataFrame) -> DataFrame:
    """Each place's own and its cell's coordinates, geographic and projected, and the distances between them."""
    found = nearest_cells(src_grid, points)
    both = projected(
        projected(found, x="community_x", y="community_y"), lat="exact_lat", lon="exact_lon", x="exact_x", y="exact_y"
    )
    c = F.col
    return both.select(
        "name", c("lat").alias("community_lat"), c("lon").alias("community_lon"), "community_x", "community_y",
        *CELL, "exact_lat", "exact_lon", "exact_x", "exact_y",
        planar_km(c("community_x"), c("community_y"), c("exact_x"), c("exact_y")).alias("planar_km"),
        sphere_km(c("lat"), c("lon"), c("exact_lat"), c("exact_lon")).alias("sphere_km"),
    )


def cell_series(
    hourly: DataFrame, cells: DataFrame, variable: str, units: str | None = None, rows: int | None = None
) -> DataFrame:
    """Daily mean in Celsius of the given cells: ``(south_north, west_east, [level,] time, value)``.

    One scan of the source serves all cells.  ``rows`` is a proven bound of the rows of ``cells``.
    """
    level = ["level"] if "level" in hourly.columns else []
    cells = stored(cells.select(*CELL).distinct(), small=True)
    # The cells' rows and columns, or boxes around many of them, reach the scan.
    hourly = near_cells(hourly, CELL, cells, rows)
    return (
        hourly.select("time", *CELL, *level, F.col(variable).alias("value"))
        .join(broadcast_within(cells, rows), list(CELL), "left_semi")
        .groupBy(day_of("time").alias("time"), *CELL, *level)
        .agg((F.avg(present(F.col("value"))) + celsius_shift(F.lit(units).cast("string"), "kelvin")).alias("value"))
    )


def source_versus_product(
    hourly: DataFrame,
    src_grid: DataFrame,
    fields: DataFrame,
    points: DataFrame,
    source: Grid,
    target: Grid,
    *,
    variable: str = "T2",
    product_variable: str = "t2_mean",
    source_units: str | None = None,
    product_units: str | None = None,
) -> DataFrame:
    """For each place and level, the neighbour offset at which source and product agree best.

    The product is read at the place's own coordinates (``community``) and at
    those of its source cell (``exact``).  Source and product are scanned once each, and
    each pair of a source and a product cell is compared once, however many places share it.
    A table without a level has one row per place and a missing level.
    """
    rows = row_bound(points)
    report = stored(coordinate_report(points, src_grid))
    around = neighbourhood(report.select("name", *CELL), source.y.n, source.x.n)
    level = F.col("level") if "level" in hourly.columns else F.lit(None).cast("int")
    series = cell_series(hourly, around, variable, source_units, None if rows is None else 9 * rows).withColumn("level", level)

    kinds = F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"{k}_x").alias("x"), F.col(f"{k}_y").alias("y")) for k in KINDS
    ]))
    shift = celsius_shift(F.lit(product_units).cast("string"), "unchanged")
    places = nearest_on_grid(report.select("name", kinds), target, tolerance=None).select("kind", "name", "y_idx", "x_idx")
    pairs = stored(around.join(places, "name").select("kind", "name", "di", "dj", *CELL, "y_idx", "x_idx"))
    product_cells = pairs.select("y_idx", "x_idx").distinct()
    few = None if rows is None else len(KINDS) * rows
    fields = near_cells(fields.where(F.col("variable") == product_variable), ["y_idx", "x_idx"], product_cells, few)
    days = join_cells(fields, product_cells, ["y_idx", "x_idx"], None if rows is None else len(KINDS) * rows)
    days = days.select("y_idx", "x_idx", "time", "level", (F.col("value") + shift).alias("right_value"))

    # Days of the source cells, then of the product cells: both joins have the day in their key.
    cells = pairs.select(*CELL, "y_idx", "x_idx").distinct()
    left = join_cells(series.withColumnRenamed("value", "left_value"), cells, list(CELL), None if rows is None else 9 * len(KINDS) * rows)
    same = (F.col("l.level").eqNullSafe(F.col("r.level"))) & (F.col("l.time") == F.col("r.time")) & (F.col("l.y_idx") == F.col("r.y_idx")) & (F.col("l.x_idx") == F.col("r.x_idx"))
    both = left.alias("l").join(days.alias("r"), same).select("l.*", "r.right_value")
    mads = mean_abs_difference(both, [*CELL, "y_idx", "x_idx", "level"])
    best = best_offset(pairs.join(mads, [*CELL, "y_idx", "x_idx"]), ["name", "kind", "level"])
    columns = [
        F.max(F.when(F.col("kind") == k, F.col(c))).alias(f"{k}_{c}") for k in KINDS for c in ("di", "dj", "mad")
    ]
    return report.select("name").join(best.groupBy("name", "level").agg(*columns), "name", "left")
