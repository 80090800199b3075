"""Z-order codes of cells, and coverings of cells by few boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers of 31 bits make codes of 62.
BITS = 31


def _spread(number: Column) -> Column:
    """The bits of a number, each with a zero before it."""
    x = number.cast("bigint").bitwiseAND(F.lit((1 << BITS) - 1))
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def z_code(row: Column, column: Column) -> Column:
    """The two numbers, of 31 bits each, bit by bit: cells of an aligned square of 2**k by 2**k have consecutive codes."""
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column))


def covering_boxes(cells: DataFrame, keys: Sequence[str], most: int = 32) -> list[tuple[int, int, int, int]]:
    """At most ``most`` boxes, as first and last row and first and last column, that hold all cells.

    Aligned squares in Z-order, as large as the cells' extent calls for, or half as large for as long as there are few of them, shrunk to the
    cells in them. Only numbers of squares and the boxes themselves reach the driver.
    """
    row, column = (F.col(k) for k in keys)
    cells = cells.select(*keys).dropna().withColumn("z", z_code(row, column))
    extent = cells.agg(F.min(row).alias("r0"), F.max(row).alias("r1"), F.min(column).alias("c0"), F.max(column).alias("c1")).first()
    if extent.r0 is None:
        return []

    def squares(size: int) -> list[tuple[int, int, int, int]] | None:
        own = cells.groupBy(F.shiftright("z", 2 * size).alias("square")).agg(F.min(row), F.max(row), F.min(column), F.max(column))
        found = own.limit(most + 1).collect()
        return sorted(tuple(r)[1:] for r in found) if len(found) <= most else None

    def number(size: int) -> int:
        return ((extent.r1 >> size) - (extent.r0 >> size) + 1) * ((extent.c1 >> size) - (extent.c0 >> size) + 1)

    size = next(k for k in range(BITS + 1) if number(k) <= most)
    boxes = squares(size)
    while size and 2 * len(boxes) <= most and (finer := squares(size - 1)):
        size, boxes = size - 1, finer
    return boxes


def in_boxes(boxes: Sequence[tuple[int, int, int, int]], keys: Sequence[str]) -> Column:
    """Whether a cell lies in one of the boxes, as comparisons that reach a Parquet scan."""
    row, column = (F.col(k) for k in keys)

    def either(part: Sequence[tuple[int, int, int, int]]) -> Column:
        # Halved again and again, so that the expression stays shallow.
        if len(part) == 1:
            top, bottom, left, right = part[0]
            return (row >= top) & (row <= bottom) & (column >= left) & (column <= right)
        return either(part[: len(part) // 2]) | either(part[len(part) // 2 :])

    return either(boxes) if boxes else F.lit(False)
