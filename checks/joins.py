"""Joins (J), sorts and set operations (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.base import check
from checks.scans import CATALOG_VIEW, FILE_VIEW, LOG_VIEW, PAGE_NAME, PAGE_PHRASES, file_vars, page_logs
from checks.views import with_views
from daygrid import catalog as cat
from daygrid.grids import Axis, Grid
from daygrid.operators import audit
from daygrid.operators.compare import align
from daygrid.operators.daily import daily_wide, time_axis
from daygrid.operators.nearest import nearest_cells, nearest_on_axis, nearest_on_grid, neighbourhood
from daygrid.operators.regrid import full_cube, stored_regrid_map
from daygrid.plans.points import projected
from daygrid.plans.verify import assemble
from daygrid.sizing import stored
from daygrid.sources import logs
from daygrid.sources.hourly import append_in_time

_CELL_DAY = {
    "cell_days": "cell_days as (select south_north, west_east, time, avg(value) as value from days group by all)",
}


def cell_days(spark, sf_dir):
    return v.days(spark, sf_dir).groupBy("south_north", "west_east", "time").agg(F.avg("value").alias("value"))


@check("j1_inner_alignment", with_views("""
select a.south_north, a.west_east, cast(a.time as varchar) as day, round(a.value, 6) as left_value, round(b.value, 6) as right_value
from cell_days a join cell_days b on a.south_north = b.south_north and a.time = b.time and a.west_east = b.west_east - 1""", _CELL_DAY))
def _(spark, sf_dir):
    """Each cell's series next to that of its eastern neighbour."""
    d = cell_days(spark, sf_dir)
    east = d.withColumn("west_east", F.col("west_east") - 1)
    return align(d, east, ["south_north", "west_east", "time"]).select(
        "south_north", "west_east", F.col("time").cast("string").alias("day"),
        F.round("left_value", 6).alias("left_value"), F.round("right_value", 6).alias("right_value"),
    )


def _index_grid(rows):
    """The grid whose coordinates are the cell indices themselves."""
    return Grid(Axis(0.0, 1.0, v.WIDTH), Axis(0.0, 1.0, rows), "index")


_NEAREST = """select id, cast(greatest(0, least(floor(tx + 0.5e0), 9)) as integer) as x_idx,
  cast(greatest(0, least(floor(ty + 0.5e0), ny - 1)) as integer) as y_idx, tx, ty from tgt, domain"""


@check("j2_nearest_with_tolerance", with_views(f"""
select n.id, n.y_idx, n.x_idx, round(avg(f.value), 6) as value from ({_NEAREST}) n
join fields f on f.y_idx = n.y_idx and f.x_idx = n.x_idx
where abs(n.x_idx - n.tx) <= 2.5e0 and abs(n.y_idx - n.ty) <= 2.5e0 group by all"""))
def _(spark, sf_dir):
    rows = v.grid_rows(spark, sf_dir)
    located = nearest_on_grid(v.tgt(spark, sf_dir), _index_grid(rows), x="tx", y="ty", tolerance=2.5, on_miss="null")
    hits = located.dropna(subset=["y_idx"]).select("id", "y_idx", "x_idx")
    values = v.fields(spark, sf_dir).groupBy("y_idx", "x_idx").agg(F.avg("value").alias("value"))
    return hits.join(values, ["y_idx", "x_idx"]).withColumn("value", F.round("value", 6))


_UNEVEN = """select k.c_custkey as id, a.money, a.idx from customer k join (
  select money, arg_min(idx, (abs(coordinate - money), -coordinate)) as idx, min(abs(coordinate - money)) as far
  from (select distinct round(c_acctbal * 100) as money from customer) p,
    (select round(s_acctbal * 100) as coordinate, min(s_suppkey) as idx from supplier group by 1) x group by money) a
on a.money = round(k.c_acctbal * 100) where far <= 5000.0e0"""


def _uneven(spark, sf_dir, **options):
    """Customers' balances on the uneven axis of the suppliers' balances, in cents."""
    axis = v.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("idx"), F.round(F.col("s_acctbal") * 100).alias("coordinate"))
    points = v.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.round(F.col("c_acctbal") * 100).alias("money"))
    return nearest_on_axis(points, axis, "money", tolerance=5000.0, on_miss="null", **options).dropna(subset=["idx"])


@check("j2_uneven_axis", _UNEVEN)
def _(spark, sf_dir):
    return _uneven(spark, sf_dir)


@check("j2_long_axis", _UNEVEN)
def _(spark, sf_dir):
    """The same by the way that is meant for axes too long for an array."""
    return _uneven(spark, sf_dir, longest=0)


@check("j3_nearest", with_views("select name, y_idx, x_idx from located"))
def _(spark, sf_dir):
    grid = v.product_grid(v.grid_rows(spark, sf_dir))
    return nearest_on_grid(projected(v.points(spark, sf_dir)), grid, tolerance=None).select("name", "y_idx", "x_idx")


@check("j4_nearest_2d", with_views("select name, south_north, west_east from found"))
def _(spark, sf_dir):
    return nearest_cells(v.cells(spark, sf_dir), v.points(spark, sf_dir)).select("name", "south_north", "west_east")


@check("j5_exact_coordinates", with_views("select name, round(exact_lat, 6) as exact_lat, round(exact_lon, 6) as exact_lon from found"))
def _(spark, sf_dir):
    return nearest_cells(v.cells(spark, sf_dir), v.points(spark, sf_dir)).select(
        "name", F.round("exact_lat", 6).alias("exact_lat"), F.round("exact_lon", 6).alias("exact_lon")
    )


_AROUND = {
    "steps": "steps as (select cast(a.range as integer) - 1 as di, cast(b.range as integer) - 1 as dj from range(3) a, range(3) b)",
    "around": """around as (select name, di, dj, greatest(0, least(south_north + dj, ny - 1)) as south_north,
  greatest(0, least(west_east + di, 9)) as west_east from found, steps, domain)""",
}


@check("j6_neighbourhood", with_views("""
select a.name, a.di, a.dj, a.south_north, a.west_east, count(*) as n, round(avg(d.value), 6) as value
from around a join days d on a.south_north = d.south_north and a.west_east = d.west_east group by all""", _AROUND))
def _(spark, sf_dir):
    found = nearest_cells(v.cells(spark, sf_dir), v.points(spark, sf_dir)).select("name", "south_north", "west_east")
    around = neighbourhood(found, v.grid_rows(spark, sf_dir), v.WIDTH)
    reduced = v.days(spark, sf_dir).groupBy("south_north", "west_east").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("value")
    )
    return around.join(reduced, ["south_north", "west_east"])


@check("j7_assembly", with_views("""
select name, round(lat, 6) as community_lat, round(lon, 6) as community_lon, south_north, west_east,
  round(exact_lat, 6) as exact_lat, round(x, 3) as x, round(y, 3) as y
from points full join (select name, south_north, west_east, exact_lat from found) f using (name)
full join (select name, x, y from points_xy) p using (name)"""))
def _(spark, sf_dir):
    p = v.points(spark, sf_dir)
    own = p.select("name", F.round("lat", 6).alias("community_lat"), F.round("lon", 6).alias("community_lon"))
    cell = nearest_cells(v.cells(spark, sf_dir), p).select("name", "south_north", "west_east", F.round("exact_lat", 6).alias("exact_lat"))
    plane = projected(p).select("name", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))
    return assemble([own, cell, plane])


@check("j8_regrid", with_views("""
select cast(d0.time as varchar) as day, m.y_idx, m.x_idx, round(m.y, 2) as y, round(m.x, 2) as x, round(d.t2_mean, 6) as t2_mean
from calendar d0 cross join grid_map m
left join (select cast(time as date) as time, south_north, west_east, avg(T2) - 273.15e0 as t2_mean from years_hourly group by all) d
  on d.time = d0.time and d.south_north = m.south_north and d.west_east = m.west_east"""))
def _(spark, sf_dir):
    rows = v.grid_rows(spark, sf_dir)
    target = v.target_grid(rows)
    h = v.years_hourly(spark, sf_dir)
    cells = stored_regrid_map(spark, v.model_grid(rows), target)
    daily = stored(daily_wide(h, ["t2_mean"]).withColumn("level", F.lit(None).cast("int")))
    return full_cube(daily, cells, target.cells, time_axis(daily)).select(
        F.col("time").cast("string").alias("day"), "y_idx", "x_idx",
        F.round("y", 2).alias("y"), F.round("x", 2).alias("x"), F.round("t2_mean", 6).alias("t2_mean"),
    )


# The product's units: years of the orders; expected: five variables, ten years.
_WORK = {
    "expected": "expected as (select r_name as variable, cast(1992 + y.range as integer) as year from region, range(10) y)",
    "existing": "existing as (select distinct cast(year(o_orderdate) as integer) as year from orders)",
}


def expected_units(spark, sf_dir):
    return audit.work_list(v.table(spark, sf_dir, "region").select(F.col("r_name").alias("variable")), 1992, 2001)


def existing_years(spark, sf_dir):
    return v.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@check("j9_work_list", with_views("select variable, year, n from expected left join (select year(o_orderdate) as year, count(*) as n from orders group by all) o using (year)", _WORK))
def _(spark, sf_dir):
    counts = v.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return expected_units(spark, sf_dir).join(counts, "year", "left")


@check("j10_completeness", with_views("""
select variable, year, 'missing' as status from expected where year not in (select year from existing)
union all select variable, year, 'existing' from expected where year in (select year from existing)""", _WORK))
def _(spark, sf_dir):
    expected, existing = expected_units(spark, sf_dir), existing_years(spark, sf_dir)
    missing = audit.missing_units(expected, existing, ["year"]).withColumn("status", F.lit("missing"))
    found = audit.present_units(expected, existing, ["year"]).withColumn("status", F.lit("existing"))
    return missing.unionByName(found)


# Requested names, right and wrong, derived from the kinds of events.
REQUESTS = {"click": "T2", "error": "RH2_M", "purchase": "rainnc_sum", "signup": "xwspd10_maxx", "view": "view"}


def requests(spark, sf_dir):
    name = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(r)) for k, r in REQUESTS.items()])
    return v.table(spark, sf_dir, "events").select(name.alias("name"))


_REQUESTS = {**CATALOG_VIEW, "requests": f"requests as (select {v.sql_case('event_type', REQUESTS)} as name from events)"}


@check("j11_catalogue_lookup", with_views("""
select r.name, r.n, c.var_id, c.units, c.agg_kind from (select name, count(*) as n from requests group by name) r left join catalog c using (name)""", _REQUESTS))
def _(spark, sf_dir):
    counted = requests(spark, sf_dir).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return cat.with_catalog(counted, on="name", how="left").select("name", "n", "var_id", "units", "agg_kind")


@check("j12_did_you_mean", with_views("""
select r.name, c.name is not null as is_valid,
  case when c.name is not null then concat('''', r.name, ''' is in the catalogue')
    when s.names is not null then concat('''', r.name, ''' is unknown; similar names: ', s.names)
    else concat('''', r.name, ''' is unknown') end as message
from (select distinct name from requests) r left join catalog c using (name)
left join (select q.name, string_agg(c.name, ', ' order by c.pos) as names from (select distinct name from requests) q, catalog c
  where contains(lower(c.name), lower(q.name)) or contains(lower(q.name), lower(c.name)) group by q.name) s on s.name = r.name""", _REQUESTS))
def _(spark, sf_dir):
    return cat.request_report(requests(spark, sf_dir), "name")


_BOTH = " and ".join(f"contains(content, '{p}')" for p in PAGE_PHRASES)


@check("j13_retry_list", with_views(f"""
select distinct variable, year from page_logs where {_BOTH} and variable in (select lang from documents)""", LOG_VIEW))
def _(spark, sf_dir):
    variables = v.table(spark, sf_dir, "documents").select(F.col("lang").alias("variable")).distinct()
    found = logs.timed_out(page_logs(spark, sf_dir), PAGE_NAME, PAGE_PHRASES)
    first, last = logs.units_of(page_logs(spark, sf_dir), PAGE_NAME).agg(F.min("year"), F.max("year")).first()
    return logs.retry_list(found, audit.work_list(variables, first, last))


@check("g1_sorted_names", with_views("select path, variables from sets", FILE_VIEW))
def _(spark, sf_dir):
    sets = audit.variable_sets(file_vars(spark, sf_dir))
    return sets.select("path", F.array_join("variables", ",").alias("variables")).orderBy("path")


@check("g2_first_n", with_views("select path from (select distinct path from file_vars) d order by path limit 10", FILE_VIEW))
def _(spark, sf_dir):
    return file_vars(spark, sf_dir).select("path").distinct().orderBy("path").limit(10)


@check("g4_set_equality", with_views("""
select path, variables = (select variables from sets order by path limit 1) as same from sets""", FILE_VIEW))
def _(spark, sf_dir):
    sets = audit.variable_sets(file_vars(spark, sf_dir))
    return audit.compared_sets(sets).select("path", F.col("is_baseline").alias("same"))


@check("g5_concatenation", with_views("""
select cast(cast(time as date) as varchar) as day, var_id, count(*) as n, round(sum(value), 4) as total from obs group by all"""))
def _(spark, sf_dir):
    o = v.obs(spark, sf_dir)
    middle = F.lit("2024-01-10").cast("timestamp_ntz")
    both = append_in_time([o.where(F.col("time") >= middle), o.where(F.col("time") < middle)])
    return both.groupBy(F.to_date("time").cast("string").alias("day"), "var_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@check("g6_common_times", with_views("""
select a.time as day, a.n as n_shipped, b.n as n_ordered
from (select cast(time as varchar) as time, count(*) as n from days group by all) a
join (select cast(cast(o_orderdate as date) as varchar) as time, count(*) as n from orders group by all) b using (time)"""))
def _(spark, sf_dir):
    """Days on which goods were shipped and ordered."""
    shipped = v.days(spark, sf_dir).groupBy(F.col("time").cast("string").alias("day"))
    ordered = v.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").cast("string").alias("day"))
    both = align(shipped.agg(F.count(F.lit(1)).alias("value")), ordered.agg(F.count(F.lit(1)).alias("value")), ["day"])
    return both.withColumnsRenamed({"left_value": "n_shipped", "right_value": "n_ordered"})
