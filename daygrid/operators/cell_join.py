"""Joining dated rows to a table of cells, safe against crowded cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.sizing import BROADCAST_ROWS, broadcast_within

DAY_SALTS = 8


def join_cells(
    dated: DataFrame,
    cells: DataFrame,
    keys: Sequence[str],
    rows: int | None,
    *,
    day_salts: int = DAY_SALTS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of rows that have a ``time`` with cells; ``rows`` is a proven bound of the cells, or None.

    Cells within the broadcast bound are sent to the dated rows, which then need
    no shuffle.  Otherwise the join key is the cell and a salt made from the
    day: whatever holds many rows of one cell, on either side, is spread over
    ``day_salts`` partitions.
    """
    if rows is not None and rows <= broadcast_rows:
        return dated.join(broadcast_within(cells, rows, broadcast_rows), list(keys))
    salt = F.pmod(F.unix_date(F.to_date("time")), F.lit(day_salts))
    salted = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(day_salts - 1))))
    return dated.withColumn("salt", salt).join(salted, [*keys, "salt"]).drop("salt")
