"""From hourly data to the daily product, many variables and years in one job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.catalog import DailyVariable, resolve
from daygrid.functions.aggregates import AggregateBuilder
from daygrid.functions.projections import ALASKA_ALBERS, SOURCE_PLANE
from daygrid.grids import Grid
from daygrid.operators.daily import daily_wide, output_groups, relevant_rows, time_axis, to_long
from daygrid.operators.regrid import full_cube, regrid, stored_regrid_map
from daygrid.sizing import BROADCAST_ROWS, stored
from daygrid.sources.hourly import for_outputs, require_columns, require_years
from daygrid.sources.product import attributes_frame, check_free, committed_units, new_commit, publish, read_product, stage_wide


def product_wide(
    hourly: DataFrame,
    names: Iterable[str | DailyVariable],
    source: Grid,
    target: Grid,
    *,
    fill_missing: bool = True,
    kinds: dict[str, AggregateBuilder] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    source_plane=SOURCE_PLANE,
    target_plane=ALASKA_ALBERS,
    cells: DataFrame | None = None,
) -> DataFrame:
    """The requested outputs as columns, one row per day, level and target cell.

    Hours are reduced first and reprojected after, all outputs of a cell and
    day in one row, so the join sees one row where the source had 24 per
    variable.  With ``fill_missing`` the result is a full cube: every target cell
    on every day between the first and the last of a year and at every level, with missing values where
    the source has no row.  The daily rows are stored, so that days and levels are
    read from them and the hours are scanned once.  ``cells`` is the regrid map of
    the two grids, if it has been made already.
    """
    return _wide(hourly, names, source, target, fill_missing, kinds, broadcast_rows, source_plane, target_plane, cells)[0]


def _wide(
    hourly: DataFrame, names: Iterable[str | DailyVariable], source: Grid, target: Grid, fill_missing: bool = True, kinds: dict[str, AggregateBuilder] | None = None,
    broadcast_rows: int = BROADCAST_ROWS, source_plane=SOURCE_PLANE, target_plane=ALASKA_ALBERS, cells: DataFrame | None = None,
) -> tuple[DataFrame, tuple[int | None, ...] | None]:
    """The rows of :func:`product_wide`, and their levels if they are known."""
    entries = resolve(names)
    hourly = relevant_rows(hourly, entries)
    if cells is None:
        cells = stored_regrid_map(hourly.sparkSession, source, target, source_plane, target_plane)
    daily = daily_wide(hourly, entries, kinds=kinds)
    if "level" not in daily.columns:
        daily = daily.withColumn("level", F.lit(None).cast("int"))
    if fill_missing:
        daily = stored(daily)
        axis = time_axis(daily)
        if axis.days:
            return full_cube(daily, cells, target.cells, axis, broadcast_rows=broadcast_rows).withColumn("year", F.year("time")), axis.levels
    wide = regrid(daily, cells, target.cells, broadcast_rows=broadcast_rows)
    return wide.withColumn("year", F.year("time")), None


def product_fields(
    hourly: DataFrame,
    names: Iterable[str | DailyVariable],
    source: Grid,
    target: Grid,
    *,
    source_plane=SOURCE_PLANE,
    target_plane=ALASKA_ALBERS,
    **options,
) -> DataFrame:
    """The product rows of the requested outputs, one row per value; options as for :func:`product_wide`."""
    cells = stored_regrid_map(hourly.sparkSession, source, target, source_plane, target_plane)
    parts = [
        to_long(product_wide(hourly, group, source, target, cells=cells, **options), group)
        for group in output_groups(hourly, names)
    ]
    return reduce(DataFrame.unionByName, parts)


def produce(
    hourly: DataFrame,
    names: Iterable[str | DailyVariable],
    first_year: int,
    last_year: int,
    source: Grid,
    target: Grid,
    root: str,
    *,
    overwrite: bool = False,
    resume: bool = False,
    attributes: Mapping[str, str] | None = None,
    years_per_job: int | None = None,
    source_plane=SOURCE_PLANE,
    target_plane=ALASKA_ALBERS,
    **options,
) -> DataFrame:
    """Write the units (variable, year) of a request and return them as read back.

    ``hourly`` has a ``year`` column; ``names`` may hold entries of the user's own, with their aggregate in
    ``kinds``.  A source column that the files of some year lack is an error.  Existing output is an error unless
    ``overwrite`` is set, which replaces the units of the request and no others, or ``resume``, which
    leaves units that the manifest has as they are and makes the others.
    With ``years_per_job`` the years are written in several jobs. Each job's units are staged and then count all at once,
    so a run that dies keeps what it had finished, and one with ``resume`` goes on from there.
    Attributes that the source columns carry as metadata are kept with the
    product; ``attributes`` adds or replaces some.  ``options`` are those of :func:`product_wide`.
    """
    entries = resolve(names)
    outputs = [e.name for e in entries]
    spark = hourly.sparkSession
    done: set[tuple[str, int]] = set()
    if resume:
        asked = F.col("variable").isin(outputs) & F.col("year").between(first_year, last_year)
        done = {(r.variable, r.year) for r in committed_units(spark, root).where(asked).collect()}
    elif not overwrite:
        check_free(spark, root, outputs, first_year, last_year)
    rows = for_outputs(require_years(hourly, first_year, last_year), entries)
    require_columns(hourly, [e.var_id for e in entries], first_year, last_year)
    inherited = {e.name: hourly.schema[e.var_id].metadata for e in entries}
    cells = stored_regrid_map(spark, source, target, source_plane, target_plane)
    step = years_per_job or last_year - first_year + 1
    for start in range(first_year, last_year + 1, step):
        # Years that lack the same outputs are made together.
        lacking: dict[tuple[DailyVariable, ...], list[int]] = {}
        for year in range(start, min(start + step, last_year + 1)):
            lacking.setdefault(tuple(e for e in entries if (e.name, year) not in done), []).append(year)
        for wanted, years in lacking.items():
            if wanted:
                _one_job(rows.where(F.col("year").isin(years)), wanted, years, source, target, root, cells, options, attributes, inherited)
    return read_product(spark, root, outputs, (first_year, last_year))


def _one_job(rows, entries, years, source, target, root, cells, options, attributes, inherited) -> None:
    """Stage the outputs of some years, and let them count."""
    spark, commit = rows.sparkSession, new_commit()
    for group in output_groups(rows, entries):
        wide, levels = _wide(for_outputs(rows, group), group, source, target, cells=cells, **options)
        stage_wide(wide, group, target, root, commit, years, levels)
    publish(spark, root, commit, attributes_frame(spark, entries, years, target, attributes, inherited=inherited))
