"""Whole analyses (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.base import check, num
from checks.joins import _AROUND, _WORK, expected_units, existing_years
from checks.reductions import _ANNUAL, _LINE, PERIODS
from checks.scans import FILE_VIEW, LOG_VIEW, PAGE_NAME, PAGE_PHRASES, file_vars, page_logs
from checks.views import sql_albers, with_views
from daygrid.catalog import CATALOG
from daygrid.operators import audit
from daygrid.plans.health import schema_consistency
from daygrid.plans.points import annual_point_series, point_normals
from daygrid.plans.produce import produce
from daygrid.plans.verify import source_versus_product
from daygrid.sizing import shared_folder
from daygrid.sources.logs import timed_out

_SQL_KIND = {"mean": "avg({})", "min": "min({})", "max": "max({})", "sum": "coalesce(sum({}), 0)"}


def _outputs(names, view, key):
    """SQL of the daily outputs as rows ``(variable, time, south_north, west_east, value)``."""
    return f"{key} as (" + " union all ".join(
        f"select '{n}' as variable, cast(time as date) as time, south_north, west_east, "
        f"{_SQL_KIND[CATALOG[n].agg_kind].format(CATALOG[n].var_id)} + cast('{CATALOG[n].offset}' as double) as value "
        f"from {view} group by cast(time as date), south_north, west_east"
        for n in names
    ) + ")"


def _unit_rows(product):
    return product.select("variable", "year", F.col("time").cast("string").alias("day"), "y_idx", "x_idx", F.round("value", 6).alias("value"))


@check("k1_produce_unit", with_views(f"""
select 'rainnc_sum' as variable, cast(year(c.time) as integer) as year, cast(c.time as varchar) as day, y_idx, x_idx, round(value, 6) as value
from event_calendar c cross join event_map m left join daily_out d on d.time = c.time and d.south_north = m.south_north and d.west_east = m.west_east""",
    {"daily_out": _outputs(["rainnc_sum"], "hourly", "daily_out")}))
def _(spark, sf_dir):
    """One variable and year, written as a full cube and read back."""
    rows = v.grid_rows(spark, sf_dir, "events", "user_id")
    product = produce(
        v.hourly(spark, sf_dir), ["rainnc_sum"], 2024, 2024, v.model_grid(rows), v.target_grid(rows), shared_folder(spark)
    )
    return _unit_rows(product)


K2_NAMES = ["t2_mean", "t2_min", "t2_max", "rainnc_sum"]


@check("k2_produce_units", with_views(f"""
select n.variable, cast(year(c.time) as integer) as year, cast(c.time as varchar) as day, y_idx, x_idx, round(value, 6) as value
from (select unnest({K2_NAMES}) as variable) n cross join calendar c cross join grid_map m
left join daily_out d on d.variable = n.variable and d.time = c.time and d.south_north = m.south_north and d.west_east = m.west_east""",
    {"daily_out": _outputs(K2_NAMES, "years_hourly", "daily_out")}))
def _(spark, sf_dir):
    """Four variables and seven years in one job, as full cubes."""
    rows = v.grid_rows(spark, sf_dir)
    product = produce(
        v.years_hourly(spark, sf_dir), K2_NAMES, 1995, 2001, v.model_grid(rows), v.target_grid(rows),
        shared_folder(spark),
    )
    return _unit_rows(product)


TOLERANCE = 110000.0
_AT_POINTS = {
    "hits": f"""hits as (select name, y_idx, x_idx from located
  where abs({num(-900000.0)} + x_idx * {num(200000.0)} - x) <= {num(TOLERANCE)} and abs({num(2400000.0)} - y_idx * ({num(2100000.0)} / ny) - y) <= {num(TOLERANCE)})""",
    "at_points": "at_points as (select name, variable, time, value from fields join hits using (y_idx, x_idx))",
    "point_years": _ANNUAL["annuals"].replace("annuals as", "point_years as").replace("y_idx, x_idx, year", "name, cast(year(time) as integer) as year", 1)
    .replace("from fields group by variable, y_idx, x_idx, year", "from at_points group by variable, name, cast(year(time) as integer)"),
    "point_trends": f"point_trends as (select variable, name, {_LINE}, regr_slope(value, year) as b, regr_intercept(value, year) as a from point_years group by variable, name)",
}


def _series(spark, sf_dir, variables):
    grid = v.product_grid(v.grid_rows(spark, sf_dir))
    series = annual_point_series(
        v.fields(spark, sf_dir), v.points(spark, sf_dir), grid, variables, tolerance=TOLERANCE, on_miss="null"
    )
    return series.drop("level").withColumns({
        c: F.round(c, 6) for c in ["value", "slope", "per_decade", "mean", "intercept", "fitted"]
    })


_SERIES = """select variable, name, p.year, round(value, 6) as value, tag, t.years, t.slope, t.per_decade, t.intercept, t.mean, round(a + b * p.year, 6) as fitted
from point_years p join point_trends t using (variable, name)"""


@check("k3_annual_point_series", with_views(f"{_SERIES} where variable = 'rainnc_sum'", _AT_POINTS))
def _(spark, sf_dir):
    return _series(spark, sf_dir, ["rainnc_sum"])


@check("k4_annual_series_of_many", with_views(f"{_SERIES} ", _AT_POINTS))
def _(spark, sf_dir):
    return _series(spark, sf_dir, None)


@check("k5_two_period_normals", with_views("""
select variable, name, cast(dayofyear(time) as integer) as dayofyear,
  round(avg(value) filter (where year(time) between 1995 and 1997), 6) as normal_1,
  round(avg(value) filter (where year(time) between 1998 and 2001), 6) as normal_2
from at_points where year(time) between 1995 and 2001 group by 1, 2, 3""", _AT_POINTS))
def _(spark, sf_dir):
    grid = v.product_grid(v.grid_rows(spark, sf_dir))
    normals = point_normals(
        v.fields(spark, sf_dir), v.points(spark, sf_dir), grid, None, PERIODS,
        tolerance=TOLERANCE, on_miss="null",
    )
    return normals.drop("level").withColumns({c: F.round(c, 6) for c in ["normal_1", "normal_2"]})


_EX, _EY = sql_albers("exact_lon", "exact_lat")
_VERIFY = {
    **_AROUND,
    "source_days": """source_days as (select a.name, a.south_north, a.west_east, cast(h.time as date) as time, avg(h.T2) - 273.15e0 as value
  from (select distinct name, south_north, west_east from around) a join years_hourly h using (south_north, west_east) group by all)""",
    "product_days": """product_days as (select y_idx, x_idx, time, value from
  (select cast(time as date) as time, south_north, west_east, avg(T2) - 273.15e0 as value from years_hourly group by all) d
  join grid_map using (south_north, west_east))""",
    "places": f"""places as (select 'community' as kind, name, x, y from points_xy
  union all select 'exact', name, {_EX}, {_EY} from found)""",
    "place_cells": f"""place_cells as (select kind, name,
  cast(greatest(0, least(11, floor((x + {num(950000.0)}) / {num(170000.0)} + 0.5e0))) as integer) as x_idx,
  cast(greatest(0, least(ny + 1, ceil(({num(2400000.0)} - y) / ({num(2000000.0)} / ny) - 0.5e0))) as integer) as y_idx from places, domain)""",
    "cell_differences": """cell_differences as (select kind, s.name, s.south_north, s.west_east, avg(abs(p.value - s.value)) as mad
  from place_cells c join product_days p using (y_idx, x_idx) join source_days s on s.name = c.name and s.time = p.time group by all)""",
    "differences": "differences as (select * from around join cell_differences using (name, south_north, west_east))",
    "best": """best as (select * from (select *, row_number() over (partition by kind, name order by mad, di, dj) as place from differences) r where place = 1)""",
}


@check("k6_source_versus_product", with_views("""
select name, e.di as exact_di, e.dj as exact_dj, round_even(e.mad, 2) as exact_mad, c.di as community_di, c.dj as community_dj, round_even(c.mad, 2) as community_mad
from points left join (select * from best where kind = 'exact') e using (name) left join (select * from best where kind = 'community') c using (name)""", _VERIFY))
def _(spark, sf_dir):
    rows = v.grid_rows(spark, sf_dir)
    source, target = v.model_grid(rows), v.target_grid(rows)
    hourly = v.years_hourly(spark, sf_dir)
    fields = produce(hourly, ["t2_mean"], 1995, 2001, source, target, shared_folder(spark))
    return source_versus_product(
        hourly, v.cells(spark, sf_dir), fields, v.points(spark, sf_dir), source, target, product_units="degree_C"
    ).drop("level")


@check("k8_schema_consistency", with_views("""
select path, variables, variables = (select variables from sets order by path limit 1) as is_baseline from sets
where variables <> (select variables from sets order by path limit 1)""", FILE_VIEW))
def _(spark, sf_dir):
    """Files that deviate from the first file's variable set."""
    odd = audit.deviating_files(audit.variable_sets(file_vars(spark, sf_dir)))
    return odd.select("path", F.array_join("variables", ",").alias("variables"), F.lit(False).alias("is_baseline"))


@check("k8_file_headers", """
with files as (select distinct event_type, case when event_type in ('purchase', 'view') then 'event_id,event_type,ts,user_id,value' else 'event_id,ts,user_id,value' end as variables from events)
select variables, count(*) as files, variables = (select arg_min(variables, event_type) from files) as is_baseline from files group by variables""")
def _(spark, sf_dir):
    """One file for each type of event, some with a column that the others lack; the sets are read from the files."""
    root, events = shared_folder(spark), v.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "user_id", "value")
    for kind in sorted(r.event_type for r in events.select("event_type").distinct().collect()):
        own = events.where(F.col("event_type") == kind)
        (own if kind in ("purchase", "view") else own.drop("event_type")).coalesce(1).write.parquet(f"{root}/{kind}")
    _, groups = schema_consistency(spark, root)
    return groups.select(F.array_join("variables", ",").alias("variables"), "files", "is_baseline")


@check("k9_completeness_check", with_views("""
select count(*) as expected, count(x.year) as existing, count(*) - count(x.year) as missing, round(100.0e0 * count(x.year) / count(*), 6) as rate
from expected left join existing x using (year)""", _WORK))
def _(spark, sf_dir):
    done = audit.completion(expected_units(spark, sf_dir), existing_years(spark, sf_dir), keys=["year"])
    return done.withColumn("rate", F.round("rate", 6))


_BOTH = " and ".join(f"contains(content, '{p}')" for p in PAGE_PHRASES)


@check("k10_timed_out_units", with_views(f"select path, variable, year from page_logs where {_BOTH}", LOG_VIEW))
def _(spark, sf_dir):
    return timed_out(page_logs(spark, sf_dir), PAGE_NAME, PAGE_PHRASES)
