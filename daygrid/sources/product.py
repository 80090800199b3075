"""The daily product: daily fields in files by unit, their attributes, and a manifest of what is whole.

A unit is one (variable, year).  A run writes its units below a folder of its own, ``fields/commit=<id>``, and their
attributes below ``attributes/commit=<id>``; nothing that exists is touched.  Only when all of it is there, one file is added to ``manifest``
that names the units, their rows and the commit that holds them.  The last entry of a unit counts, readers
open no commit that has no entry, and a run that dies leaves the product as it was.

Rows are spread over files by level and tile of cells and sorted in Z-order inside each file, so that reading a few cells
skips nearly all row groups.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.catalog import DailyVariable, resolve
from daygrid.functions.zorder import z_code
from daygrid.grids import Grid
from daygrid.operators.audit import UNIT
from daygrid.operators.daily import to_long
from daygrid.schema import ATTRIBUTES, MANIFEST, PRODUCT
from daygrid.session import SETTINGS
from daygrid.sources.hourly import read_table

# A task of a write holds about this many values of one year and level.
VALUES_PER_TILE = 128_000_000
DAYS_PER_YEAR = 366
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# A year of a level is spread over at least this many tiles along the longer side of the grid.
TILES_PER_SIDE = 4


def fields_path(root: str, commit: str | None = None) -> str:
    return f"{root}/fields" if commit is None else f"{root}/fields/commit={commit}"


def attributes_path(root: str, commit: str | None = None) -> str:
    return f"{root}/attributes" if commit is None else f"{root}/attributes/commit={commit}"


def manifest_path(root: str) -> str:
    return f"{root}/manifest"


def all_entries(spark: SparkSession, root: str) -> DataFrame | None:
    """The manifest: every unit of every commit, with ``current`` for those that count; None where nothing was committed."""
    entries = read_table(spark, manifest_path(root), MANIFEST)
    if entries is None:
        return None
    newest = F.row_number().over(Window.partitionBy(*UNIT).orderBy(F.col("sequence").desc(), "commit"))
    return entries.withColumn("current", newest == 1)


def committed_units(spark: SparkSession, root: str) -> DataFrame:
    """Units that are whole, with their row count; no data file is opened."""
    entries = all_entries(spark, root)
    if entries is None:
        return spark.createDataFrame([], MANIFEST).select(*UNIT, "rows")
    return entries.where("current AND rows > 0").select(*UNIT, "rows")


def read_product(
    spark: SparkSession, root: str, variables: Iterable[str] | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Daily fields of committed units; variables and years are chosen by partition, so no other file is opened."""
    entries = all_entries(spark, root)
    if entries is None:
        raise FileNotFoundError(f"no product at {root}")
    units = entries.select("commit", *UNIT, "current").collect()  # as many as units were ever written
    live = sorted({u.commit for u in units if u.current})
    table = spark.read.schema(PRODUCT).option("basePath", fields_path(root)).parquet(*[fields_path(root, c) for c in live])
    # Of a commit all units count but those that were written again later.
    replaced = [u for u in units if not u.current and u.commit in live]
    if replaced:
        by_commit = {c: sorted({(u.variable, u.year) for u in replaced if u.commit == c}) for c in {u.commit for u in replaced}}
        old = [(F.col("commit") == c) & F.concat_ws("/", *UNIT).isin([f"{v}/{y}" for v, y in gone]) for c, gone in sorted(by_commit.items())]
        table = table.where(~reduce(lambda a, b: a | b, old))
    table = table.select(PRODUCT.names)
    if variables is not None:
        table = table.where(F.col("variable").isin(list(variables)))
    if years is not None:
        table = table.where(F.col("year").between(*years))
    return table


def valid_units(fields: DataFrame) -> DataFrame:
    """Units that exist and are not empty, with their row count (read from file footers)."""
    return fields.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("rows"))


def check_free(spark: SparkSession, root: str, variables: Iterable[str], first_year: int, last_year: int) -> None:
    """Fail if any unit of a request has output already."""
    asked = F.col("variable").isin(list(variables)) & F.col("year").between(first_year, last_year)
    taken = committed_units(spark, root).where(asked).orderBy(*UNIT).limit(10).collect()
    if taken:
        units = ", ".join(f"{r.variable}/{r.year}" for r in taken)
        raise FileExistsError(f"output exists and overwrite is off: {units}")


def tile_side(outputs: int, grid: Grid | None = None) -> int:
    """Side of the square tiles that cells are grouped in, a power of two: smaller when a row has more outputs, and several to a grid."""
    side = max(1, math.isqrt(VALUES_PER_TILE // (DAYS_PER_YEAR * outputs)))
    if grid is not None:
        side = min(side, math.ceil(max(grid.x.n, grid.y.n) / TILES_PER_SIDE))
    return 1 << (side.bit_length() - 1)


def _tiles(outputs: int, grid: Grid) -> tuple[int, int, int]:
    """Side of a tile, and the number of tiles along y and x."""
    side = tile_side(outputs, grid)
    return side, -(-grid.y.n // side), -(-grid.x.n // side)


def files_per_unit(outputs: int, grid: Grid, levels: int = 1) -> int:
    """How many files a unit gets that is written with so many outputs in a row; of a cube no tile is empty."""
    _, rows, columns = _tiles(outputs, grid)
    return rows * columns * levels


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Rows in the order of a file: by level, then cells in Z-order, which are near to each other in both directions.

    The code is a column while rows are sorted; as an expression it would be computed for every comparison.
    """
    coded = rows.withColumn("_z", z_code(F.col("y_idx"), F.col("x_idx")))
    return coded.sortWithinPartitions(*first, "_z", "time").drop("_z")


def stage_wide(
    wide: DataFrame, names: Iterable[str | DailyVariable], grid: Grid, root: str, commit: str,
    years: Sequence[int] | None = None, levels: Sequence[int | None] | None = None,
) -> None:
    """Write units below a commit from rows that hold all outputs of a cell and day.

    Rows are shuffled by year, level and tile while all outputs still share one
    row, and only then become one row per output.  With ``years`` and ``levels``, which must be all there are, every
    year, level and tile is a partition of its own, so a unit has :func:`files_per_unit` files. Without, they are dealt by hash.
    Where the session lets a task keep one file open per output (``spark.sql.maxConcurrentOutputFileWriters``; as in
    :mod:`daygrid.session` if it says nothing), rows are sorted before that too, and never as single values.
    """
    entries = resolve(names)
    side, n_rows, n_columns = _tiles(len(entries), grid)
    tile = F.floor(F.col("y_idx") / side) * n_columns + F.floor(F.col("x_idx") / side)
    if years and levels:
        # Absent values sort first, as in ``levels``.
        level = F.array_position(F.array(*[F.lit(-1 if n is None else n) for n in levels]), F.coalesce("level", F.lit(-1))) - 1
        year = F.array_position(F.array(*map(F.lit, years)), F.col("year")) - 1
        tiles = n_rows * n_columns
        place = (year * len(levels) + level) * tiles + tile
        placed = wide.repartitionById(len(years) * len(levels) * tiles, place.cast("int"))
        first = []  # a partition has one year and one level
    else:
        placed = wide.repartition("year", "level", tile)
        first = ["year", "level"]
    conf = wide.sparkSession.conf
    own = conf.get(OPEN_FILES, None)
    open_files = int(own or SETTINGS[OPEN_FILES])
    if len(entries) > open_files:
        _stage(_in_order(to_long(placed, entries), *UNIT, "level"), root, commit)
        return
    try:
        conf.set(OPEN_FILES, str(open_files))
        _stage(to_long(_in_order(placed, *first), entries), root, commit)
    finally:
        if own is None:
            conf.unset(OPEN_FILES)


def stage_fields(fields: DataFrame, root: str, commit: str) -> None:
    """Write units below a commit from rows that hold one value each."""
    side = tile_side(1)
    placed = fields.repartition("variable", "year", "level", F.floor(F.col("y_idx") / side), F.floor(F.col("x_idx") / side))
    _stage(_in_order(placed, *UNIT, "level"), root, commit)


def _stage(fields: DataFrame, root: str, commit: str) -> None:
    """Write rows in their order; groups of outputs that share a commit are added to each other."""
    fields.select(PRODUCT.names).write.mode("append").option("compression", "zstd").partitionBy(*UNIT).parquet(fields_path(root, commit))


def new_commit() -> str:
    return uuid.uuid4().hex


def publish(spark: SparkSession, root: str, commit: str, attributes: DataFrame | None = None) -> None:
    """Make the staged units of a commit count, each in place of the one before.

    Their rows are counted from the footers, the attributes are written, and then one file is added to the manifest, which is one rename.
    Two runs on the same product at a time are not foreseen; if they happen, the commit with the lesser id stands.
    """
    staged = read_table(spark, fields_path(root, commit), PRODUCT)
    if staged is None:
        return
    if attributes is not None:
        write_attributes(attributes, root, commit)
    entries = all_entries(spark, root)
    last = None if entries is None else entries.agg(F.max("sequence")).first()[0]
    units = valid_units(staged).select(*UNIT, F.lit(commit).alias("commit"), "rows", F.lit((last or 0) + 1).cast("bigint").alias("sequence"))
    units.coalesce(1).write.mode("append").parquet(manifest_path(root))


def write_wide(wide: DataFrame, names: Iterable[str | DailyVariable], grid: Grid, root: str, **known) -> None:
    """Write and publish units from rows that hold all outputs of a cell and day; a unit that exists is replaced."""
    commit = new_commit()
    stage_wide(wide, names, grid, root, commit, **known)
    publish(wide.sparkSession, root, commit)


def write_fields(fields: DataFrame, root: str) -> None:
    """Write and publish units from rows that hold one value each; a unit that exists is replaced."""
    commit = new_commit()
    stage_fields(fields, root, commit)
    publish(fields.sparkSession, root, commit)


def remove_stale(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of commits that no unit counts from: runs that died, and units replaced since. Not while a run writes."""
    entries = all_entries(spark, root)
    live = set() if entries is None else {r.commit for r in entries.where("current").select("commit").distinct().collect()}
    gone = []
    for folder in (fields_path(root), attributes_path(root)):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(path) if files.exists(path) else []:
            commit = status.getPath().getName().removeprefix("commit=")
            if status.isDirectory() and status.getPath().getName().startswith("commit=") and commit not in live:
                files.delete(status.getPath(), True)
                gone.append(commit)
    return sorted(set(gone))


def variable_attributes(entry: DailyVariable) -> dict[str, str]:
    """Attributes of a value column; what the catalogue does not say is ``unknown``."""
    return {
        "long_name": entry.description or f"Daily {entry.name}",
        "units": entry.units or "unknown",
        "standard_name": entry.standard_name or "unknown",
        "cell_methods": entry.cell_methods or "unknown",
    }


# Attributes of a source field that its daily product does not inherit.
DROPPED_ATTRIBUTES = ("description", "projection")


def merge_attributes(inherited: Mapping[str, str], entry: DailyVariable) -> dict[str, str]:
    """Source attributes, without those that no longer hold, under the catalogue's own."""
    kept = {k: v for k, v in inherited.items() if k not in DROPPED_ATTRIBUTES}
    return {**kept, **variable_attributes(entry)}


def dataset_attributes(
    entry: DailyVariable, grid: Grid, created: datetime | None = None, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Attributes of a unit as a whole; institution, source and references come from the caller."""
    stamp = (created or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S UTC")
    return {
        "Conventions": "CF-1.8",
        "title": f"Daily aggregated {entry.name} on {grid.crs}",
        "institution": "unknown",
        "source": "unknown",
        "history": f"{stamp}: Created with Spark",
        "comment": f"Variable '{entry.name}', reduced from hours to days and reprojected to {grid.crs}.",
        "references": "unknown",
        "time_standard_name": "time",
        "time_axis": "T",
        **grid.attributes(),
        **(extra or {}),
    }


def with_attributes(fields: DataFrame, attrs: Mapping[str, str]) -> DataFrame:
    """Attach attributes to the ``value`` column's schema metadata (kept by Parquet)."""
    return fields.withMetadata("value", dict(attrs))


def attributes_frame(
    spark: SparkSession,
    names: Iterable[str],
    years: Iterable[int],
    grid: Grid,
    extra: Mapping[str, str] | None = None,
    created: datetime | None = None,
    inherited: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """One row per unit with all its attributes as a map; as many rows as units."""

    def attributes(e: DailyVariable) -> dict[str, str]:
        own = {k: str(v) for k, v in (inherited or {}).get(e.name, {}).items()}
        return {**merge_attributes(own, e), **dataset_attributes(e, grid, created, extra)}

    rows = [(e.name, y, attributes(e)) for e in resolve(names) for y in years]
    return spark.createDataFrame(rows, "variable string, year int, attrs map<string,string>")


def write_attributes(attributes: DataFrame, root: str, commit: str | None = None) -> None:
    attributes.select(ATTRIBUTES.names).coalesce(1).write.mode("append").parquet(attributes_path(root, commit or new_commit()))


def read_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Attributes of the units that count; of all that are there where no manifest is."""
    table = spark.read.schema(ATTRIBUTES).parquet(attributes_path(root))
    entries = all_entries(spark, root)
    if entries is not None:
        table = table.join(entries.where("current").select("commit", *UNIT), ["commit", *UNIT], "left_semi")
    return table.select(ATTRIBUTES.names)


def read_grid(spark: SparkSession, root: str) -> Grid:
    """The grid of a product, from the attributes of one of its units."""
    unit = read_attributes(spark, root).first()
    if unit is None:
        raise FileNotFoundError(f"no product attributes at {root}")
    return Grid.from_attributes(unit.attrs)
