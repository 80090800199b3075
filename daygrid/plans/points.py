"""Values at named places: annual series with trend, and day-of-year normals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.catalog import DailyVariable, resolve
from daygrid.functions.projections import ALASKA_ALBERS, SOURCE_PLANE
from daygrid.functions.zorder import covering_boxes, in_boxes
from daygrid.grids import Grid
from daygrid.operators.cell_join import join_cells
from daygrid.operators.daily import daily_outputs
from daygrid.operators.nearest import nearest_on_grid
from daygrid.operators.regrid import stored_regrid_map
from daygrid.operators.yearly import NORMAL_PERIODS, Period, annual_by_rule, normals_two_periods, with_fit
from daygrid.sizing import BROADCAST_ROWS, broadcast_within, row_bound, stored

# Places as (latitude, longitude).
TOWNS: dict[str, tuple[float, float]] = {
    "Anchorage": (61.2181, -149.9003),
    "Fairbanks": (64.8378, -147.7164),
    "Bethel": (60.7922, -161.7558),
    "Valdez": (61.1308, -146.3483),
    "Point Hope": (68.3477, -166.8089),
    "Kotzebue": (66.8983, -162.5966),
    "Nome": (64.5011, -165.4064),
    "Utqiaġvik": (71.2906, -156.7886),
    "Cordova": (60.5438, -145.7573),
}

# The places of the source check; the last is the centre of the model domain.
CHECK_PLACES: dict[str, tuple[float, float]] = {
    "Anchorage": (61.2181, -149.9003),
    "Fairbanks": (64.8378, -147.7164),
    "Utqiaġvik": (71.2906, -156.7886),
    "Bethel": (60.7922, -161.7558),
    "Cordova": (60.5438, -145.7573),
    "Nome": (64.5011, -165.4064),
    "Seward": (60.1044, -149.4458),
    "WRF": (64.0, -152.0),
}

# Up to this many points are located ahead of the query, and their indices become a filter of its scan. Of more
# points it is boxes around their cells.
FEW_POINTS = 500


def places_frame(spark: SparkSession, places: Mapping[str, tuple[float, float]]) -> DataFrame:
    return spark.createDataFrame([(n, lat, lon) for n, (lat, lon) in places.items()], "name string, lat double, lon double")


def projected(points: DataFrame, plane=ALASKA_ALBERS, lat: str = "lat", lon: str = "lon", x: str = "x", y: str = "y") -> DataFrame:
    """Attach plane coordinates to points given by latitude and longitude."""
    px, py = plane.forward(F.col(lon), F.col(lat))
    return points.withColumns({x: px, y: py})


def extract_points(
    fields: DataFrame, points: DataFrame, grid: Grid, *, tolerance: float | None = 5000.0, on_miss: str = "error",
    few_points: int | None = None, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The daily values of the cells nearest to the points, with the points' own columns.

    ``points`` has ``x, y`` in the plane of the product and any columns that
    name a point.  Few points are located first and broadcast, and the grid
    rows and columns they lie in become a scan filter, which skips most pages of
    files sorted by cell.  Many points are joined by cell, and the scan is filtered by boxes around them.  ``few_points`` (else ``FEW_POINTS``) and
    ``broadcast_rows`` say what is few; they change the plan and not the rows.
    """
    few_points = FEW_POINTS if few_points is None else few_points
    names, cells, rows = _locate(points, grid, tolerance, on_miss, few_points)
    keys = ["y_idx", "x_idx"]
    keep = [c for c in ("variable", "level", "time", "value") if c in fields.columns]
    return join_cells(near_cells(fields, keys, cells, rows, few_points), cells, keys, rows, broadcast_rows=broadcast_rows).select(*names, *keep)


def _locate(points: DataFrame, grid: Grid, tolerance: float | None, on_miss: str, few_points: int) -> tuple[list[str], DataFrame, int | None]:
    """The points' own columns, the cells they lie in, and a bound of their number if there is one."""
    names = [c for c in points.columns if c not in ("x", "y", "lat", "lon")]
    located = nearest_on_grid(points, grid, tolerance=tolerance, on_miss=on_miss).select(*names, "y_idx", "x_idx")
    few = located.limit(few_points + 1).collect()
    if len(few) > few_points:
        return names, stored(located.dropna(subset=["y_idx", "x_idx"])), row_bound(points)
    hits = [r for r in few if r.y_idx is not None]
    return names, points.sparkSession.createDataFrame(hits, located.schema), len(hits)


def near_cells(rows: DataFrame, keys: Sequence[str], cells: DataFrame, bound: int | None, few_points: int = FEW_POINTS) -> DataFrame:
    """``rows`` without those that the grid rows and columns of a few cells, or some boxes around many, show to be of no use."""
    if bound is None or bound > few_points:
        return rows.where(in_boxes(covering_boxes(cells, keys), keys))
    found = cells.select(*keys).distinct().collect()
    for k in keys:
        wanted = sorted({r[k] for r in found})
        rows = rows.where(F.col(k).isin(wanted) if wanted else F.lit(False))
    return rows


def extract_points_from_hours(
    hourly: DataFrame,
    variables: Iterable[str | DailyVariable],
    points: DataFrame,
    source: Grid,
    target: Grid,
    *,
    tolerance: float | None = 5000.0,
    on_miss: str = "error",
    source_plane=SOURCE_PLANE,
    target_plane=ALASKA_ALBERS,
) -> DataFrame:
    """The values that :func:`extract_points` would give on the product of ``hourly``, without making the product.

    Reprojection picks whole source cells, so only the hours of the cells that
    the points end up in are read and reduced.  The rows that the full cube has without a value, for
    points outside the source domain and for days on which a cell has no hours, are left out: they would take the whole calendar to know.
    """
    entries = resolve(variables)
    names, cells, rows = _locate(points, target, tolerance, on_miss, FEW_POINTS)
    grid_map = stored_regrid_map(hourly.sparkSession, source, target, source_plane, target_plane)
    keys = ["south_north", "west_east"]
    wanted = (
        grid_map.where(F.col("south_north").isNotNull())
        .join(broadcast_within(cells, rows), ["y_idx", "x_idx"])
        .select(*names, *keys)
    )
    only = broadcast_within(wanted.select(*keys).distinct(), rows)
    hours = near_cells(hourly, keys, wanted, rows, FEW_POINTS).join(only, keys, "left_semi")
    return join_cells(daily_outputs(hours, entries), wanted, keys, rows).drop(*keys)


def annual_point_series(
    fields: DataFrame, points: DataFrame, grid: Grid, variables: Iterable[str] | None = None, **extract
) -> DataFrame:
    """Annual series of each place, level and variable with trend, fitted line and long-term mean."""
    if variables is not None:
        fields = fields.where(F.col("variable").isin(list(variables)))
    daily = extract_points(fields, projected(points), grid, **extract)
    series = annual_by_rule(daily, _place(daily))
    return with_fit(series, ["variable", *_place(daily)])


def point_normals(
    fields: DataFrame,
    points: DataFrame,
    grid: Grid,
    variables: Iterable[str] | None = None,
    periods: tuple[Period, Period] = NORMAL_PERIODS,
    **extract,
) -> DataFrame:
    """Day-of-year normals of two periods for each place, level and variable."""
    if variables is not None:
        fields = fields.where(F.col("variable").isin(list(variables)))
    if "year" in fields.columns:
        first, second = (F.col("year").between(*p) for p in periods)
        fields = fields.where(first | second)
    daily = extract_points(fields, projected(points), grid, **extract)
    return normals_two_periods(daily, ["variable", *_place(daily)], periods)


def _place(daily: DataFrame) -> list[str]:
    """What tells the series of a variable apart: the place, and the level where the table has one."""
    return [c for c in ("name", "level") if c in daily.columns]
