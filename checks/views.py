"""The test tables in the shapes that the package works on, as DataFrames and as SQL.

``VIEWS`` holds the SQL of each view; :func:`with_views` puts a statement on top
of the views that it names, in the order of ``VIEWS``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import num
from daygrid.catalog import CATALOG, LEVELLED_SOURCES, source_variables
from daygrid.functions.projections import ALASKA_ALBERS, SOURCE_PLANE
from daygrid.grids import Axis, Grid, source_grid

WIDTH = 10

# Which source variable each kind of event stands for.
EVENT_VARIABLES = {"click": "T2", "error": "SEAICE", "purchase": "rainnc", "signup": "rh2", "view": "wspd10"}
# Which daily variable each line number stands for.
LINE_VARIABLES = ["t2_mean", "t2_min", "t2_max", "rainnc_sum", "wspd10_max", "rain_total", "wdir10_mean"]
SOURCES = source_variables(CATALOG)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _row(key: str) -> Column:
    return F.floor(F.col(key) / WIDTH).cast("int")


def _column(key: str) -> Column:
    return (F.col(key) % WIDTH).cast("int")


def event_variable() -> Column:
    return F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_VARIABLES.items()])


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly observations as rows ``(time, south_north, west_east, var_id, value)``."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"), _row("user_id").alias("south_north"), _column("user_id").alias("west_east"),
        event_variable().alias("var_id"), "value",
    )


def obs_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations with NaN wherever the number of cents is a multiple of three, or the variable is sea ice."""
    gap = (F.bround(F.col("value") * 100).cast("bigint") % 3 == 0) | (F.col("var_id") == "SEAICE")
    return obs(spark, sf_dir).withColumn("value", F.when(gap, F.lit(float("nan"))).otherwise(F.col("value")))


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly wind directions."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"), _row("user_id").alias("south_north"), _column("user_id").alias("west_east"),
        F.lit("wdir10").alias("var_id"), (F.col("value") % 360).alias("value"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly table with one column per source variable; a row holds the variable of its event."""
    o = obs(spark, sf_dir)
    return o.select(
        "time", "south_north", "west_east", F.year("time").alias("year"),
        *[F.when(F.col("var_id") == v, F.col("value")).alias(v) for v in EVENT_VARIABLES.values()],
    )


def hourly_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly table with all source variables and levels: no level, 1 or 2, by event."""
    level = F.nullif(F.col("event_id") % 3, F.lit(0)).cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"), level.alias("level"),
        _row("user_id").alias("south_north"), _column("user_id").alias("west_east"),
        *[(F.col("value") + i).alias(v) for i, v in enumerate(SOURCES)],
    )


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of daily values: ``(time, south_north, west_east, value)``, quantities."""
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("time"), _row("l_suppkey").alias("south_north"),
        _column("l_suppkey").alias("west_east"), F.col("l_quantity").alias("value"),
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily product over several years and variables, on the grid of :func:`product_grid`."""
    names = F.array(*[F.lit(n) for n in LINE_VARIABLES])
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("time"), F.lit(None).cast("int").alias("level"),
        _row("l_suppkey").alias("y_idx"), _column("l_suppkey").alias("x_idx"), F.col("l_quantity").alias("value"),
        F.element_at(names, F.col("l_linenumber")).alias("variable"), F.year("l_shipdate").alias("year"),
    )


def years_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of source data: temperature and rain."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("time"), _row("l_suppkey").alias("south_north"),
        _column("l_suppkey").alias("west_east"), F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("T2"), F.col("l_tax").alias("rainnc"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curvilinear grid: ``(south_north, west_east, lat, lon)``."""
    r, c = _row("s_suppkey"), _column("s_suppkey")
    return table(spark, sf_dir, "supplier").select(r.alias("south_north"), c.alias("west_east")).select(
        "*",
        (F.lit(55.0) + F.lit(0.1) * F.col("south_north") + F.lit(0.01) * F.col("west_east")).alias("lat"),
        (F.lit(-165.0) + F.lit(0.5) * F.col("west_east")).alias("lon"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named places."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"),
        (F.lit(55.0) + (k % 5) * F.lit(3.0)).alias("lat"), (F.lit(-165.0) + (k % 7) * F.lit(5.0)).alias("lon"),
    )


def tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abstract target centres, some of them off the index grid."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("id"), (F.lit(3.7) + F.lit(1.3) * (k % 10)).alias("tx"),
        (F.lit(2.2) + F.lit(0.9) * F.floor(k / 10)).alias("ty"),
    )


def grid_rows(spark: SparkSession, sf_dir: str, name: str = "supplier", key: str = "s_suppkey") -> int:
    """Rows of the test domain; like the shape of a file, one number from the table."""
    return table(spark, sf_dir, name).agg(F.floor(F.max(key) / WIDTH).cast("int") + 1).first()[0]


def model_grid(rows: int) -> Grid:
    """The model domain: 2,000 km square around the centre, whatever the number of rows."""
    return source_grid(-152.0, 64.0, 200000.0, 2000000.0 / rows, WIDTH, rows)


def target_grid(rows: int) -> Grid:
    """A target grid that reaches beyond the model domain."""
    return Grid(Axis(-950000.0, 170000.0, 12), Axis(2400000.0, -2000000.0 / rows, rows + 2), ALASKA_ALBERS.name)


def product_grid(rows: int) -> Grid:
    """The grid of :func:`fields`."""
    return Grid(Axis(-900000.0, 200000.0, WIDTH), Axis(2400000.0, -2100000.0 / rows, rows), ALASKA_ALBERS.name)


# --- SQL -----------------------------------------------------------------


def _sql_row(key: str) -> str:
    return f"cast(floor({key} / {WIDTH}) as integer)"


def _sql_column(key: str) -> str:
    return f"cast({key} % {WIDTH} as integer)"


def sql_case(column: str, mapping: dict) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + " end"


def sql_albers(lon: str, lat: str) -> tuple[str, str]:
    """Forward Alaska Albers in SQL."""
    p = ALASKA_ALBERS
    n, c, rho_0 = p._cone()
    e = p.e2**0.5
    s = f"sin(radians({lat}))"
    q = f"({num(1 - p.e2)} * ({s} / (1 - {num(p.e2)} * {s} * {s}) - ln((1 - {num(e)} * {s}) / (1 + {num(e)} * {s})) / {num(2 * e)}))"
    rho = f"({num(p.a)} * sqrt({num(c)} - {num(n)} * {q}) / {num(n)})"
    wrapped = f"((({lon} - {num(p.lon_0)} + 180) % 360 + 360) % 360 - 180)"
    theta = f"radians({num(n)} * {wrapped})"
    return f"({rho} * sin({theta}))", f"({num(rho_0)} - {rho} * cos({theta}))"


def sql_albers_inverse(cte: str, source: str, keep: str) -> str:
    """CTEs that add ``lon`` and ``lat`` to a relation with ``x`` and ``y``; the last is called ``cte``."""
    p = ALASKA_ALBERS
    n, c, rho_0 = p._cone()
    e2 = p.e2
    import math

    qp = p._q(1.0, math)
    q = f"(({num(c)} - (x * x + ({num(rho_0)} - y) * ({num(rho_0)} - y)) * {num((n / p.a) ** 2)}) / {num(n)})"
    return f"""{cte}_beta as (select {keep}, x, y, asin({q} / {num(qp)}) as beta from {source}),
{cte} as (select {keep}, x, y,
  {num(p.lon_0)} + degrees(atan2(x, {num(rho_0)} - y)) / {num(n)} as lon,
  degrees(beta + {num(e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040)} * sin(2 * beta)
    + {num(23 * e2**2 / 360 + 251 * e2**3 / 3780)} * sin(4 * beta)
    + {num(761 * e2**3 / 45360)} * sin(6 * beta)) as lat
  from {cte}_beta)"""


def sql_stereo(lon: str, lat: str) -> tuple[str, str]:
    """Forward polar stereographic in SQL."""
    p = SOURCE_PLANE
    rho = f"({num(p._scale)} * tan(pi() / 4 - radians({lat}) / 2))"
    angle = f"radians({lon} - {num(p.lon_0)})"
    return f"({rho} * sin({angle}))", f"(-{rho} * cos({angle}))"


def _sql_map(prefix: str, domain: str) -> dict[str, str]:
    """CTEs of the regrid map of a domain: ``<prefix>_map(y_idx, x_idx, y, x, south_north, west_east)``."""
    sx, sy = sql_stereo("lon", "lat")
    east, north = sql_stereo(num(-152.0), num(64.0))
    dy = f"({num(2000000.0)} / ny)"
    return {
        f"{prefix}_cells": f"""{prefix}_cells as (
  select cast(r.range as integer) as y_idx, cast(c.range as integer) as x_idx, ny,
    {num(2400000.0)} - r.range * {dy} as y, {num(-950000.0)} + c.range * {num(170000.0)} as x
  from {domain}, range({domain}.ny + 2) r, range(12) c)""",
        f"{prefix}_geo": sql_albers_inverse(f"{prefix}_geo", f"{prefix}_cells", "y_idx, x_idx, ny"),
        f"{prefix}_plane": f"""{prefix}_plane as (select y_idx, x_idx, y, x, ny, {sx} as sx, {sy} as sy from {prefix}_geo)""",
        f"{prefix}_number": f"""{prefix}_number as (select y_idx, x_idx, y, x, ny,
    floor((sx - ({east} - {num(4.5 * 200000.0)} - {num(100000.0)})) / {num(200000.0)}) as we,
    floor((sy - ({north} - (ny - 1) / 2.0e0 * {dy} - {dy} / 2)) / {dy}) as sn
  from {prefix}_plane)""",
        f"{prefix}_map": f"""{prefix}_map as (select y_idx, x_idx, y, x,
    case when we >= 0 and we < 10 and sn >= 0 and sn < ny then cast(sn as integer) end as south_north,
    case when we >= 0 and we < 10 and sn >= 0 and sn < ny then cast(we as integer) end as west_east
  from {prefix}_number)""",
    }


_EVENT_CELL = f"ts as time, {_sql_row('user_id')} as south_north, {_sql_column('user_id')} as west_east"
_LINE_CELL = f"{_sql_row('l_suppkey')} as south_north, {_sql_column('l_suppkey')} as west_east"
_PX, _PY = sql_albers("lon", "lat")

VIEWS: dict[str, str] = {
    "obs": f"obs as (select {_EVENT_CELL}, {sql_case('event_type', EVENT_VARIABLES)} as var_id, value from events)",
    "obs_gaps": """obs_gaps as (select time, south_north, west_east, var_id,
  case when cast(round(value * 100) as bigint) % 3 = 0 or var_id = 'SEAICE' then null else value end as value from obs)""",
    "wind": f"wind as (select {_EVENT_CELL}, value % 360 as value from events)",
    "hourly": "hourly as (select time, south_north, west_east, "
    + ", ".join(f"case when var_id = '{v}' then value end as {v}" for v in EVENT_VARIABLES.values())
    + " from obs)",
    "hourly_all": f"hourly_all as (select {_EVENT_CELL}, cast(nullif(event_id % 3, 0) as integer) as level, value from events)",
    "days": f"days as (select cast(l_shipdate as date) as time, {_LINE_CELL}, l_quantity as value from lineitem)",
    "fields": f"""fields as (select cast(l_shipdate as date) as time, {_sql_row('l_suppkey')} as y_idx,
  {_sql_column('l_suppkey')} as x_idx, l_quantity as value,
  {sql_case('cast(l_linenumber as varchar)', {str(i + 1): v for i, v in enumerate(LINE_VARIABLES)})} as variable,
  cast(year(l_shipdate) as integer) as year from lineitem)""",
    "years_hourly": f"""years_hourly as (select l_shipdate as time, {_LINE_CELL},
  cast(year(l_shipdate) as integer) as year, l_quantity as T2, l_tax as rainnc from lineitem)""",
    "cells": f"""cells as (select south_north, west_east,
  {num(55.0)} + {num(0.1)} * south_north + {num(0.01)} * west_east as lat, {num(-165.0)} + {num(0.5)} * west_east as lon
  from (select {_sql_row('s_suppkey')} as south_north, {_sql_column('s_suppkey')} as west_east from supplier) s)""",
    "points": f"""points as (select n_name as name, {num(55.0)} + (n_nationkey % 5) * {num(3.0)} as lat,
  {num(-165.0)} + (n_nationkey % 7) * {num(5.0)} as lon from nation)""",
    "points_xy": f"points_xy as (select name, lat, lon, {_PX} as x, {_PY} as y from points)",
    "tgt": f"""tgt as (select s_suppkey as id, {num(3.7)} + {num(1.3)} * (s_suppkey % 10) as tx,
  {num(2.2)} + {num(0.9)} * floor(s_suppkey / 10) as ty from supplier)""",
    "domain": "domain as (select cast(floor(max(s_suppkey) / 10) as integer) + 1 as ny from supplier)",
    "event_domain": "event_domain as (select cast(floor(max(user_id) / 10) as integer) + 1 as ny from events)",
    # Every day between the first and the last of each year, and whether it has data.
    "calendar": """calendar as (select c.time, h.time is null as gap from (
    select cast(unnest(generate_series(min(time), max(time), interval 1 day)) as date) as time
    from (select cast(cast(time as date) as timestamp) as time from years_hourly) y group by year(time)) c
  left join (select distinct cast(time as date) as time from years_hourly) h using (time))""",
    "event_calendar": """event_calendar as (select c.time, h.time is null as gap from (
    select cast(unnest(generate_series(min(time), max(time), interval 1 day)) as date) as time
    from (select cast(cast(time as date) as timestamp) as time from obs) y group by year(time)) c
  left join (select distinct cast(time as date) as time from obs) h using (time))""",
    **_sql_map("grid", "domain"),
    **_sql_map("event", "event_domain"),
    # Points with the nearest cell of the product grid, per axis: half way between two, the larger coordinate.
    "located": f"""located as (select name, lat, lon, x, y, ny,
  cast(greatest(0, least(9, floor((x + {num(900000.0)}) / {num(200000.0)} + 0.5e0))) as integer) as x_idx,
  cast(greatest(0, least(ny - 1, ceil(({num(2400000.0)} - y) / ({num(2100000.0)} / ny) - 0.5e0))) as integer) as y_idx
  from points_xy, domain)""",
    # The nearest cell of the curvilinear grid in squared degrees.
    "found": """found as (select name, lat, lon, south_north, west_east, exact_lat, exact_lon from (
  select p.name, p.lat, p.lon, c.south_north, c.west_east, c.lat as exact_lat, c.lon as exact_lon,
    row_number() over (partition by p.name order by (c.lat - p.lat) * (c.lat - p.lat) + (c.lon - p.lon) * (c.lon - p.lon),
      c.south_north, c.west_east) as place
  from points p, cells c) ranked where place = 1)""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` on top of the views it needs, directly or through other views; ``extra`` adds views of its own."""
    views = {**VIEWS, **(extra or {})}
    needed: set[str] = set()

    def need(text: str, own: str | None = None) -> None:
        for v in views:
            if v != own and v not in needed and re.search(rf"\b{v}\b", text):
                needed.add(v)
                need(views[v], v)

    need(body)
    chosen = ",\n".join(views[v] for v in views if v in needed)
    return f"with {chosen}\n{body}" if chosen else body


assert LEVELLED_SOURCES <= set(SOURCES)
