"""Nearest-cell joins: points to a regular grid, points to a curvilinear grid, and cell neighbourhoods."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from daygrid.functions.aggregates import present
from daygrid.functions.zorder import z_code
from daygrid.grids import Grid, UnevenAxis, clamp, count_below
from daygrid.sizing import stored

# A leaf box of the search tree is to hold about this many cells, and holds at most LEAF_LIMIT down to the finest boxes.
LEAF_CELLS = 64
LEAF_LIMIT = 256
# Three bits a level along each side.
MAX_DEPTH = 10
POINT_SALTS = 8
# Coordinates of an uneven axis that are searched in one array; a longer one is cut into so many stretches.
AXIS_LITERAL = 100_000
AXIS_PARTS = 256

EXTENT = ("lat_min", "lat_max", "lon_min", "lon_max")


def nearest_on_grid(
    points: DataFrame, grid: Grid, *, x: str = "x", y: str = "y", tolerance: float | None = 5000.0, on_miss: str = "error"
) -> DataFrame:
    """Attach ``y_idx`` and ``x_idx`` of the nearest grid cell, found per axis.

    With a tolerance, a point farther than it from the nearest centre on either
    axis is a miss: the query fails (``on_miss='error'``) or the indices are
    NULL (``'null'``).  ``tolerance=None`` accepts any distance.
    """
    if on_miss not in ("error", "null"):
        raise ValueError(f"on_miss must be 'error' or 'null', not {on_miss!r}")
    px, py = F.col(x), F.col(y)
    found_x, found_y = grid.x.nearest(px), grid.y.nearest(py)
    if tolerance is not None:
        hit = (F.abs(grid.x.centre(found_x) - px) <= tolerance) & (F.abs(grid.y.centre(found_y) - py) <= tolerance)
        miss = F.lit(None).cast("int")
        if on_miss == "error":
            miss = F.raise_error(
                F.format_string("no grid cell within %s of x=%s, y=%s", F.lit(tolerance), px, py)
            ).cast("int")
        found_x, found_y = F.when(hit, found_x).otherwise(miss), F.when(hit, found_y).otherwise(miss)
    return points.withColumns({"y_idx": found_y, "x_idx": found_x})


def nearest_on_axis(
    points: DataFrame, axis: DataFrame, coordinate: str, *, index: str = "idx", tolerance: float | None = None, on_miss: str = "error", longest: int = AXIS_LITERAL
) -> DataFrame:
    """Attach ``index`` of the nearest row of an uneven axis, given as a table of ``idx`` and ``coordinate``, in any order.

    Half way between two, the larger coordinate; of rows with one coordinate, the least ``idx``. With a tolerance, a farther point is a
    miss as for :func:`nearest_on_grid`. Up to ``longest`` coordinates become one array that every point is searched in; a longer axis takes
    :func:`nearest_on_long_axis`. A missing point has no index, and an axis without coordinates none for any point.
    """
    if on_miss not in ("error", "null"):
        raise ValueError(f"on_miss must be 'error' or 'null', not {on_miss!r}")
    axis = axis.select("idx", present(F.col("coordinate")).alias("coordinate")).dropna().groupBy("coordinate").agg(F.min("idx").alias("idx"))
    few = axis.limit(longest + 1).collect()
    kind = axis.schema["idx"].dataType
    x = present(F.col(coordinate))
    if not few:
        located = points.withColumns({index: F.lit(None).cast(kind), "_centre": F.lit(None).cast("double")})
    elif len(few) <= longest:
        order = sorted(few, key=lambda r: r.coordinate)
        line = UnevenAxis(tuple(r.coordinate for r in order))
        numbers = F.split(F.lit(",".join(str(r.idx) for r in order)), ",").cast(ArrayType(kind))
        located = points.withColumn("_rank", line.nearest(x))
        located = located.withColumns({index: F.get(numbers, F.col("_rank")), "_centre": line.centre(F.col("_rank"))}).drop("_rank")
    else:
        found = nearest_on_long_axis(points.select(x.alias("_x")), axis)
        found = found.select("_x", F.col("idx").alias(index), F.col("centre").alias("_centre"))
        located = points.withColumn("_x", x).join(found, "_x", "left").drop("_x")
    if tolerance is not None:
        miss = F.lit(None).cast(kind)
        if on_miss == "error":
            miss = F.raise_error(F.format_string("no axis value within %s of %s", F.lit(tolerance), x)).cast(kind)
        far = x.isNotNull() & (F.col("_centre").isNull() | (F.abs(F.col("_centre") - x) > tolerance))
        located = located.withColumn(index, F.when(far, miss).otherwise(F.col(index)))
    return located.drop("_centre")


def nearest_on_long_axis(points: DataFrame, axis: DataFrame, parts: int = AXIS_PARTS) -> DataFrame:
    """``_x, idx, centre`` for each different ``_x`` of ``points``: an as-of join of two sorted runs, without pairs.

    ``axis`` has different coordinates. The line is cut into ``parts`` stretches with about as many points and coordinates in each (by
    approximate percentiles of both); in a stretch a window finds the last coordinate up to each point and the first from it.
    The outermost coordinates of all stretches, ``2 * parts`` numbers, stand in where a stretch has none on one side.
    """
    own = points.dropna().distinct().select(F.col("_x").alias("at"), F.lit(None).cast(axis.schema["idx"].dataType).alias("idx"), F.lit(False).alias("is_axis"))
    both = own.unionByName(axis.select(F.col("coordinate").alias("at"), "idx", F.lit(True).alias("is_axis")))
    both = stored(both)
    cuts = both.agg(F.percentile_approx("at", [k / parts for k in range(1, parts)], 10 * parts).alias("cuts")).first().cuts or []
    both = both.withColumn("part", count_below(F.col("at"), sorted(set(cuts))))
    value = F.when(F.col("is_axis"), F.struct(F.col("at").alias("centre"), "idx"))
    ends = both.where("is_axis").groupBy("part").agg(F.min(F.struct(F.col("at").alias("centre"), "idx")).alias("first"), F.max(F.struct(F.col("at").alias("centre"), "idx")).alias("last"))
    ends = sorted(ends.collect())  # one row per stretch
    before, after, carried = {}, {}, None
    for k in range(parts + 1):
        before[k] = carried
        carried = next((r.last for r in ends if r.part == k), carried)
    carried = None
    for k in range(parts, -1, -1):
        after[k] = carried
        carried = next((r.first for r in ends if r.part == k), carried)
    kind = f"part int, before struct<centre: double, idx: {axis.schema['idx'].dataType.simpleString()}>, after struct<centre: double, idx: {axis.schema['idx'].dataType.simpleString()}>"
    around = F.broadcast(points.sparkSession.createDataFrame([(k, before[k], after[k]) for k in before], kind))
    # Of a point and a coordinate at the same place the coordinate comes first on the way up, and counts on the way down.
    up = Window.partitionBy("part").orderBy("at", F.col("is_axis").desc())
    left = F.last(value, ignorenulls=True).over(up)
    right = F.first(value, ignorenulls=True).over(up.rowsBetween(0, Window.unboundedFollowing))
    sided = both.withColumns({"left": left, "right": right}).where("NOT is_axis").join(around, "part")
    sided = sided.select(F.col("at").alias("_x"), F.coalesce("left", "before").alias("left"), F.coalesce("right", "after").alias("right"))
    # Compared with the midpoint, as on a short axis.
    middle = F.col("left.centre") + (F.col("right.centre") - F.col("left.centre")) / 2
    chosen = F.when(F.col("left").isNull(), F.col("right")).when(F.col("right").isNull() | (F.col("_x") < middle), F.col("left")).otherwise(F.col("right"))
    at = F.when(F.col("left.centre") == F.col("_x"), F.col("left")).otherwise(chosen)
    return sided.select("_x", at.alias("best")).select("_x", "best.idx", "best.centre")


def _squared(a: Column, b: Column) -> Column:
    return (a - b) * (a - b)


def _nearest(lat: Column, lon: Column, box: Callable[[str], Column]) -> Column:
    """Squared distance from a point to the nearest edge of a box, 0 inside it."""
    d_lat = F.greatest(F.lit(0.0), box("lat_min") - lat, lat - box("lat_max"))
    d_lon = F.greatest(F.lit(0.0), box("lon_min") - lon, lon - box("lon_max"))
    return d_lat * d_lat + d_lon * d_lon


def _farthest(lat: Column, lon: Column, box: Callable[[str], Column]) -> Column:
    """Squared distance from a point to the farthest corner of a box."""
    d_lat = F.greatest(F.abs(lat - box("lat_min")), F.abs(lat - box("lat_max")))
    d_lon = F.greatest(F.abs(lon - box("lon_min")), F.abs(lon - box("lon_max")))
    return d_lat * d_lat + d_lon * d_lon


def _coded(rows: DataFrame, box, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows with the Z-order code of the finest box that they lie in: six bits for each level, 64 boxes to a parent."""

    def number(c: str, low: float, high: float) -> Column:
        share = (F.col(c) - F.lit(low)) / F.lit(high - low) if high > low else F.col(c) * 0.0
        return clamp(F.floor(share * 8**MAX_DEPTH), 8**MAX_DEPTH)

    return rows.withColumn("code", z_code(number(lat, box["lat_min"], box["lat_max"]), number(lon, box["lon_min"], box["lon_max"])))


def _box(depth: int | Column) -> Column:
    """The box of a code at a depth."""
    if isinstance(depth, int):
        return F.shiftright("code", 6 * (MAX_DEPTH - depth))
    return F.call_function("shiftright", F.col("code"), (MAX_DEPTH - depth) * 6)


class Tree(NamedTuple):
    boxes: dict[int, DataFrame]  # by depth: box, extent, number of cells
    leaves: DataFrame  # depth, box, cell, lat, lon
    depth: int


def search_tree(cells: DataFrame, box) -> Tree:
    """A tree of boxes over ``cell, lat, lon``: a box with more than ``LEAF_LIMIT`` cells is divided, any other is a leaf.

    The boxes of the depth that evenly spread cells would need are counted in one pass, those above follow from them, and only the cells of
    boxes that are still crowded are looked at again, one depth further each time. So leaves are bounded wherever cells
    differ by more than 2**-30 of the extent.
    """

    def extent(lat_min: str, lat_max: str, lon_min: str, lon_max: str, n: Column) -> list[Column]:
        return [
            F.min(lat_min).alias("lat_min"), F.max(lat_max).alias("lat_max"),
            F.min(lon_min).alias("lon_min"), F.max(lon_max).alias("lon_max"), n.alias("n"),
        ]

    boxes: dict[int, DataFrame] = {}
    parts: list[DataFrame] = []
    rest, known = _coded(cells, box), 0
    depth = min(MAX_DEPTH, max(1, math.ceil(math.log(box["n"] / LEAF_CELLS, 64))))
    while True:
        boxes[depth] = stored(rest.groupBy(_box(depth).alias("box")).agg(*extent("lat", "lat", "lon", "lon", F.count(F.lit(1)))), small=True)
        for k in range(depth - 1, known, -1):
            boxes[k] = boxes[k + 1].groupBy(F.shiftright("box", 6).alias("box")).agg(*extent(*EXTENT, F.sum("n")))
        # The first depth at which a box's ancestor, or itself, has few cells.
        fits = boxes[depth].select("box", F.when((F.col("n") <= LEAF_LIMIT) | F.lit(depth == MAX_DEPTH), depth).alias("leaf"))
        for k in range(depth - 1, known, -1):
            above = boxes[k].where(F.col("n") <= LEAF_LIMIT).select(F.col("box").alias("up"), F.lit(k).alias("higher"))
            fits = fits.join(above, F.shiftright("box", 6 * (depth - k)) == F.col("up"), "left").select("box", F.coalesce("higher", "leaf").alias("leaf"))
        placed = rest.withColumn("box", _box(depth)).join(fits, "box").drop("box")
        parts.append(placed.where("leaf IS NOT NULL").select(F.col("leaf").alias("depth"), _box(F.col("leaf")).alias("box"), "cell", "lat", "lon"))
        if depth == MAX_DEPTH or boxes[depth].where(F.col("n") > LEAF_LIMIT).isEmpty():
            return Tree(boxes, stored(reduce(DataFrame.unionByName, parts), small=True), depth)
        rest = stored(placed.where("leaf IS NULL").drop("leaf"), small=True)
        known, depth = depth, depth + 1


def nearest_cells(grid: DataFrame, points: DataFrame) -> DataFrame:
    """For each point the cell of a curvilinear grid with the smallest squared distance in degrees.

    ``grid`` has ``(south_north, west_east, lat, lon)``, ``points`` has ``lat``
    and ``lon``; the cell comes back as ``south_north, west_east, exact_lat,
    exact_lon``.  Among equally near cells the first in row order wins.

    The search is exact and avoids comparing every point with every cell.
    Cells are grouped into a tree of boxes with 64 boxes per parent, deeper where they crowd. From the root down, a point keeps the boxes whose
    nearest edge is within the bound of its distance, and lowers the bound to the
    farthest corner of the best of them; only cells of the leaf boxes that
    remain are compared. The grid is read once; its different coordinates are stored.
    """
    grid = grid.withColumns({"lat": present(F.col("lat")), "lon": present(F.col("lon"))}).dropna(subset=["lat", "lon"])
    # Copies of a coordinate, and of a point, take part once.  ``cell`` orders cells by row and column.
    cell = F.shiftleft(F.col("south_north").cast("bigint"), 32) + F.col("west_east")
    cells = stored(grid.groupBy("lat", "lon").agg(F.min(cell).alias("cell")), small=True)
    box = cells.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
    ).first()
    if not box["n"]:
        raise ValueError("the grid has no cell with coordinates")
    tree = search_tree(cells, box)

    point = ["p_lat", "p_lon"]
    p_lat, p_lon = F.col("p_lat"), F.col("p_lon")
    probes = points.select(present(F.col("lat")).alias("p_lat"), present(F.col("lon")).alias("p_lon")).dropna().distinct()

    # The boxes of the first level are a literal of at most 64 rows, and a point keeps its candidates in one array.
    fields = ["box", *EXTENT, "n"]
    top = [{c: r[c] for c in fields} for r in sorted(tree.boxes[1].select(*fields).collect())]
    kinds = "box:bigint," + ",".join(f"{c}:double" for c in EXTENT) + ",n:bigint"
    top_boxes = F.from_json(F.lit(json.dumps(top)), f"array<struct<{kinds}>>")
    reach = F.array_min(F.transform(top_boxes, lambda b: _farthest(p_lat, p_lon, b.getField)))
    kept = F.filter(top_boxes, lambda b: _nearest(p_lat, p_lon, b.getField) <= F.col("bound"))
    frontier = probes.withColumn("bound", reach).select(*point, "bound", F.inline(kept)).withColumn("depth", F.lit(1))

    per_point = Window.partitionBy(*point)
    # The points of a crowded box are spread over so many copies of it.
    salt = F.pmod(F.xxhash64(*point), F.lit(POINT_SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(POINT_SALTS - 1)))
    inner = F.col("n") > LEAF_LIMIT
    for k in range(2, tree.depth + 1):
        children = tree.boxes[k].withColumns({"up": F.shiftright("box", 6), "salt": salts})
        # Leaves stay as they are, and count for the bound.
        opened = frontier.where(inner).select(*point, "bound", F.col("box").alias("up"), salt.alias("salt"))
        opened = opened.join(children, ["up", "salt"]).drop("up", "salt").withColumn("depth", F.lit(k))
        frontier = (
            opened.unionByName(frontier.where(~inner))
            .withColumn("bound", F.least("bound", F.min(_farthest(p_lat, p_lon, F.col)).over(per_point)))
            .where(_nearest(p_lat, p_lon, F.col) <= F.col("bound"))
        )
    distance = _squared(F.col("lat"), p_lat) + _squared(F.col("lon"), p_lon)
    found = (
        frontier.select(*point, "depth", "box", salt.alias("salt")).join(tree.leaves.withColumn("salt", salts), ["depth", "box", "salt"])
        .groupBy(*point)
        .agg(F.min_by(F.struct("cell", "lat", "lon"), F.struct(distance.alias("d"), F.col("cell"))).alias("best"))
        .select(
            F.col("p_lat").alias("lat"), F.col("p_lon").alias("lon"),
            F.shiftright("best.cell", 32).cast("int").alias("south_north"),
            F.col("best.cell").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("west_east"),
            F.col("best.lat").alias("exact_lat"), F.col("best.lon").alias("exact_lon"),
        )
    )
    return points.join(found, ["lat", "lon"], "left")


def neighbourhood(cells: DataFrame, rows: int, columns: int, reach: int = 1) -> DataFrame:
    """Each cell with its neighbours up to ``reach`` away: offsets ``di`` (west_east) and ``dj`` (south_north).

    Neighbours beyond the border are clamped to it, so border cells may appear more than once.
    """
    steps = range(-reach, reach + 1)
    offsets = F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i in steps for j in steps])
    return cells.select("*", F.inline(offsets)).withColumns({
        "south_north": clamp(F.col("south_north") + F.col("dj"), rows),
        "west_east": clamp(F.col("west_east") + F.col("di"), columns),
    })
