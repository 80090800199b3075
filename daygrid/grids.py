"""Regular grids: a driver-side record of origin, spacing and shape.

A grid is never shipped as data: coordinates and indices are affine Column
expressions of the record's numbers, and the cells of a grid come from
``spark.range``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.aggregates import present
from daygrid.functions.projections import ALASKA_ALBERS, SOURCE_PLANE


@dataclass(frozen=True)
class Axis:
    """``n`` equally spaced cell centres starting at ``origin``; ``step`` may be negative."""

    origin: float
    step: float
    n: int

    def centre(self, index: Column) -> Column:
        return F.lit(self.origin) + index * F.lit(self.step)

    def containing(self, coordinate: Column) -> Column:
        """Index of the cell that holds a coordinate, NULL outside the axis."""
        i = F.floor((present(coordinate) - F.lit(self.origin - self.step / 2)) / F.lit(self.step))
        return F.when((i >= 0) & (i < self.n), i.cast("int"))

    def nearest(self, coordinate: Column) -> Column:
        """Index of the nearest centre; half way between two, the larger coordinate."""
        steps = (present(coordinate) - F.lit(self.origin)) / F.lit(self.step)
        i = F.floor(steps + 0.5) if self.step > 0 else F.ceil(steps - 0.5)
        return clamp(i, self.n).cast("int")


@dataclass(frozen=True)
class UnevenAxis:
    """Cell centres at any distances, all different, ascending or descending; a driver-side list.

    It can stand for either axis of a :class:`Grid`. Look-ups are binary searches over a literal array of the midpoints,
    so an axis should have at most some 100,000 centres; for longer ones there is
    :func:`daygrid.operators.nearest.nearest_on_long_axis`.
    """

    coordinates: tuple[float, ...]

    def __post_init__(self):
        steps = [b - a for a, b in zip(self.coordinates, self.coordinates[1:])]
        if not self.coordinates or not all(math.isfinite(c) for c in self.coordinates):
            raise ValueError("an axis needs finite coordinates")
        if not (all(s > 0 for s in steps) or all(s < 0 for s in steps)):
            raise ValueError("coordinates must rise or fall all along an axis")

    @property
    def n(self) -> int:
        return len(self.coordinates)

    @property
    def _rising(self) -> bool:
        return self.n < 2 or self.coordinates[1] > self.coordinates[0]

    def _index(self, rank: Column) -> Column:
        """The index of a rank in ascending order."""
        return (rank if self._rising else F.lit(self.n - 1) - rank).cast("int")

    def centre(self, index: Column) -> Column:
        return F.element_at(_doubles(self.coordinates), index + 1)

    def _midpoints(self) -> list[float]:
        c = sorted(self.coordinates)
        return [a + (b - a) / 2 for a, b in zip(c, c[1:])]

    def nearest(self, coordinate: Column) -> Column:
        """Index of the nearest centre; half way between two, the larger coordinate."""
        x = present(coordinate)
        return F.when(x.isNotNull(), self._index(count_below(x, self._midpoints())))

    def containing(self, coordinate: Column) -> Column:
        """Index of the cell that holds a coordinate, NULL outside the axis; the outer cells are as wide outwards as inwards."""
        x, middle, c = present(coordinate), self._midpoints(), sorted(self.coordinates)
        low = c[0] - (middle[0] - c[0]) if middle else -math.inf
        high = c[-1] + (c[-1] - middle[-1]) if middle else math.inf
        return F.when((x >= F.lit(low)) & (x < F.lit(high)), self._index(count_below(x, middle)))


def _doubles(values) -> Column:
    """A literal array; as one text, which the optimizer folds, however long it is."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>") if values else F.array().cast("array<double>")


def count_below(x: Column, bounds) -> Column:
    """How many of the ascending ``bounds`` are not above ``x``: a binary search in powers of two."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    table = _doubles(bounds)
    further = lambda i, s: (i + s <= F.lit(len(bounds))) & (F.get(table, i + s - 1) <= x)
    return F.aggregate(steps, F.lit(0), lambda i, s: F.when(further(i, s), i + s).otherwise(i))


def clamp(index: Column, n: int | Column) -> Column:
    """An index brought into [0, n); a missing index stays missing."""
    last = n - 1 if isinstance(n, Column) else F.lit(n - 1)
    return F.when(index.isNotNull(), F.greatest(F.lit(0), F.least(index, last)))


@dataclass(frozen=True)
class Grid:
    """A regular grid in a projected plane."""

    x: Axis | UnevenAxis
    y: Axis | UnevenAxis
    crs: str

    @property
    def cells(self) -> int:
        return self.x.n * self.y.n

    def attributes(self) -> dict[str, str]:
        """The grid as text attributes, to be kept with a product."""
        attrs = {"crs": self.crs, "x_dim": "x", "y_dim": "y"}
        for d, axis in (("x", self.x), ("y", self.y)):
            if isinstance(axis, UnevenAxis):
                attrs[f"{d}_coordinates"] = " ".join(map(repr, axis.coordinates))
            else:
                attrs |= {f"{d}_origin": repr(axis.origin), f"{d}_step": repr(axis.step), f"{d}_count": str(axis.n)}
        return attrs

    @staticmethod
    def from_attributes(attrs: dict[str, str]) -> Grid:
        def axis(d: str) -> Axis | UnevenAxis:
            if f"{d}_coordinates" in attrs:
                return UnevenAxis(tuple(map(float, attrs[f"{d}_coordinates"].split())))
            return Axis(float(attrs[f"{d}_origin"]), float(attrs[f"{d}_step"]), int(attrs[f"{d}_count"]))

        return Grid(axis("x"), axis("y"), attrs["crs"])


def source_grid(cen_lon: float, cen_lat: float, dx: float, dy: float, nx: int, ny: int, plane=SOURCE_PLANE) -> Grid:
    """The model grid: ``nx`` by ``ny`` cells spread evenly around the domain centre."""
    east, north = plane.forward(cen_lon, cen_lat, math)
    return Grid(
        Axis(east - (nx - 1) / 2.0 * dx, dx, nx),
        Axis(north - (ny - 1) / 2.0 * dy, dy, ny),
        plane.name,
    )


def grid_axes(spark: SparkSession, grid: Grid) -> DataFrame:
    """Both axes as rows ``(axis, index, coordinate)``."""

    def rows(name: str, axis: Axis) -> DataFrame:
        index = F.col("id").cast("int")
        return spark.range(axis.n).select(F.lit(name).alias("axis"), index.alias("index"), axis.centre(index).alias("coordinate"))

    return rows("x", grid.x).unionByName(rows("y", grid.y))


def grid_cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """Every cell once: ``(y_idx, x_idx, y, x)``."""
    y_idx = F.expr(f"cast(id div {grid.x.n} as int)")
    x_idx = F.expr(f"cast(id % {grid.x.n} as int)")
    return spark.range(grid.cells).select(y_idx.alias("y_idx"), x_idx.alias("x_idx")).select(
        "y_idx", "x_idx", grid.y.centre(F.col("y_idx")).alias("y"), grid.x.centre(F.col("x_idx")).alias("x")
    )


def covering_grid(source: Grid, plane=SOURCE_PLANE, target=ALASKA_ALBERS) -> Grid:
    """A target grid that holds the projected source domain.

    The extent is the bounding box of the projected cell edges; square cells
    have the size that keeps the number of cells along the diagonal.
    """
    xs = [source.x.origin + (i - 0.5) * source.x.step for i in range(source.x.n + 1)]
    ys = [source.y.origin + (i - 0.5) * source.y.step for i in range(source.y.n + 1)]
    edge = [(x, y) for x in xs for y in (ys[0], ys[-1])] + [(x, y) for y in ys for x in (xs[0], xs[-1])]
    projected = [target.forward(*plane.inverse(x, y, math), math) for x, y in edge]
    left, right = min(p[0] for p in projected), max(p[0] for p in projected)
    bottom, top = min(p[1] for p in projected), max(p[1] for p in projected)
    size = math.hypot(right - left, top - bottom) / math.hypot(source.x.n, source.y.n)
    nx, ny = int((right - left) / size + 0.5), int((top - bottom) / size + 0.5)
    return Grid(Axis(left + size / 2, size, nx), Axis(top - size / 2, -size, ny), target.name)
