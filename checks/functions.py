"""Scalar functions (F)."""

from __future__ import annotations

import math


from pyspark.sql import functions as F

from checks import views as v
from checks.base import check, num
from checks.scans import LOG_VIEW, PAGE_NAME, page_logs
from checks.views import sql_albers, sql_albers_inverse, sql_stereo, with_views
from daygrid.functions.projections import ALASKA_ALBERS, SOURCE_PLANE, planar_km, sphere_km
from daygrid.grids import grid_cells
from daygrid.plans.points import projected
from daygrid.plans.verify import coordinate_report
from daygrid.sources.logs import units_of

_SX, _SY = sql_stereo("lon", "lat")


@check("f1_source_plane", with_views(f"select name, round({_SX}, 2) as x, round({_SY}, 2) as y from points"))
def _(spark, sf_dir):
    return projected(v.points(spark, sf_dir), SOURCE_PLANE).select("name", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


# Customers as places all over the domain.
_CUSTOMERS = "customers as (select c_custkey as id, 50e0 + c_custkey % 200 / 10e0 as lat, -170e0 + c_custkey % 370 / 10e0 as lon from customer)"


def customers(spark, sf_dir):
    k = F.col("c_custkey")
    return v.table(spark, sf_dir, "customer").select(
        k.alias("id"), (F.lit(50.0) + k % 200 / F.lit(10.0)).alias("lat"), (F.lit(-170.0) + k % 370 / F.lit(10.0)).alias("lon")
    )


_CX, _CY = sql_albers("lon", "lat")


@check("f2_albers", with_views(f"select id, round({_CX}, 3) as x, round({_CY}, 3) as y from customers", {"customers": _CUSTOMERS}))
def _(spark, sf_dir):
    return projected(customers(spark, sf_dir)).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


_ROUND_TRIP = {
    "customers": _CUSTOMERS,
    "flat": f"flat as (select id, {_CX} as x, {_CY} as y from customers)",
    "back": sql_albers_inverse("back", "flat", "id"),
}


@check("f3_albers_inverse", with_views("select id, round(lon, 7) as lon, round(lat, 7) as lat from back", _ROUND_TRIP))
def _(spark, sf_dir):
    plane = projected(customers(spark, sf_dir)).select("id", "x", "y")
    lon, lat = ALASKA_ALBERS.inverse(F.col("x"), F.col("y"))
    return plane.select("id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


_DX, _DY = sql_albers(num(-152.0), num(64.0))


@check("f4_planar_distance", with_views(f"select id, round_even(sqrt(({_CX} - {_DX}) * ({_CX} - {_DX}) + ({_CY} - {_DY}) * ({_CY} - {_DY})) / 1000, 3) as km from customers", {"customers": _CUSTOMERS}))
def _(spark, sf_dir):
    """Distance of every place to the centre of the domain, in the plane."""
    cx, cy = (F.lit(c) for c in ALASKA_ALBERS.forward(-152.0, 64.0, math))
    return projected(customers(spark, sf_dir)).select("id", planar_km(cx, cy, F.col("x"), F.col("y")).alias("km"))


def _sql_sphere(lat1, lon1, lat2, lon2):
    h = (
        f"sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2)"
    )
    return f"round_even(2 * 6370e0 * asin(least(1, sqrt({h}))), 3)"


@check("f5_sphere_distance", with_views(f"select id, {_sql_sphere(num(64.0), num(-152.0), 'lat', 'lon')} as km from customers", {"customers": _CUSTOMERS}))
def _(spark, sf_dir):
    """Distance of every place to the centre of the domain, on the sphere."""
    km = sphere_km(F.lit(64.0), F.lit(-152.0), F.col("lat"), F.col("lon"))
    return customers(spark, sf_dir).select("id", km.alias("km"))


_EAST, _NORTH = sql_stereo(num(-152.0), num(64.0))


@check("f6_grid_origin", with_views(f"""
select round({_EAST} - 4.5e0 * {num(200000.0)}, 2) as x_origin, round({_NORTH} - (ny - 1) / 2.0e0 * ({num(2000000.0)} / ny), 2) as y_origin,
  round({_EAST} + 4.5e0 * {num(200000.0)}, 2) as x_end, round({_NORTH} + (ny - 1) / 2.0e0 * ({num(2000000.0)} / ny), 2) as y_end,
  count(*) as cells from domain, cells group by ny"""))
def _(spark, sf_dir):
    """Where the grid of a table's cells begins and ends, from the centres of its cells."""
    grid = v.model_grid(v.grid_rows(spark, sf_dir))
    x, y = grid.x.centre(F.col("west_east")), grid.y.centre(F.col("south_north"))
    return v.cells(spark, sf_dir).agg(
        F.round(F.min(x), 2).alias("x_origin"), F.round(F.min(y), 2).alias("y_origin"),
        F.round(F.max(x), 2).alias("x_end"), F.round(F.max(y), 2).alias("y_end"), F.count(F.lit(1)).alias("cells"),
    )


@check("f8_angles", with_views("""
select event_id, round(sin(radians(value)), 9) as s, round(cos(radians(value)), 9) as c,
  round((degrees(atan2(sin(radians(value)), cos(radians(value)))) + 360) % 360, 6) as turned from events"""))
def _(spark, sf_dir):
    a = F.radians("value")
    return v.table(spark, sf_dir, "events").select(
        "event_id", F.round(F.sin(a), 9).alias("s"), F.round(F.cos(a), 9).alias("c"),
        F.round((F.degrees(F.atan2(F.sin(a), F.cos(a))) + 360) % 360, 6).alias("turned"),
    )


@check("f9_arithmetic", with_views("""
select event_id, abs(value - 50) as distance, round((value - 50) * (value - 50), 4) as square,
  round(sqrt(value * value + 9), 6) as hypotenuse, round_even(value, 0) as rounded, isnan(value) as missing from events"""))
def _(spark, sf_dir):
    c = F.col("value")
    return v.table(spark, sf_dir, "events").select(
        "event_id", F.abs(c - 50).alias("distance"), F.round((c - 50) * (c - 50), 4).alias("square"),
        F.round(F.hypot(c, F.lit(3.0)), 6).alias("hypotenuse"), F.bround(c, 0).alias("rounded"), F.isnan(c).alias("missing"),
    )


@check("f10_calendar", with_views("""
select cast(year(l_shipdate) as integer) as year, cast(dayofyear(l_shipdate) as integer) as dayofyear,
  min(cast(cast(l_shipdate as date) as varchar)) as day, count(*) as n from lineitem group by 1, 2"""))
def _(spark, sf_dir):
    t = F.col("l_shipdate")
    return v.table(spark, sf_dir, "lineitem").groupBy(F.year(t).alias("year"), F.dayofyear(t).alias("dayofyear")).agg(
        F.min(F.to_date(t).cast("string")).alias("day"), F.count(F.lit(1)).alias("n")
    )


@check("f11_strings", with_views("""
select p_partkey, upper(trim(p_name)) as upper_name, lower(p_type) as lower_type, replace(p_brand, '#', '_') as brand,
  contains(p_name, 'ring') as is_ring, split_part(p_name, ' ', 1) as first_word, concat(p_brand, '_', p_size, '_daily') as label,
  concat(upper(substr(p_name, 1, 1)), substr(split_part(p_name, ' ', 1), 2), ' ', upper(substr(split_part(p_name, ' ', 2), 1, 1)), substr(split_part(p_name, ' ', 2), 2)) as title
from part"""))
def _(spark, sf_dir):
    name = F.col("p_name")
    return v.table(spark, sf_dir, "part").select(
        "p_partkey", F.upper(F.trim(name)).alias("upper_name"), F.lower("p_type").alias("lower_type"),
        F.replace("p_brand", F.lit("#"), F.lit("_")).alias("brand"), F.contains(name, F.lit("ring")).alias("is_ring"),
        F.split(name, " ")[0].alias("first_word"),
        F.format_string("%s_%s_daily", "p_brand", "p_size").alias("label"),
        F.initcap(F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("_"), F.lit(" "))).alias("title"),
    )


@check("f12_name_pattern", with_views("select path, variable, year from page_logs where variable <> '' and year is not null", LOG_VIEW))
def _(spark, sf_dir):
    return units_of(page_logs(spark, sf_dir), PAGE_NAME).select("path", "variable", "year")


_OX, _OY = sql_albers("exact_lon", "exact_lat")


@check("f13_coordinate_report", with_views(f"""
select name, south_north, west_east, round(x, 3) as community_x, round(y, 3) as community_y, round(ex, 3) as exact_x, round(ey, 3) as exact_y,
  round_even(sqrt((ex - x) * (ex - x) + (ey - y) * (ey - y)) / 1000, 3) as planar_km, {_sql_sphere('lat', 'lon', 'exact_lat', 'exact_lon')} as sphere_km
from (select *, {_OX} as ex, {_OY} as ey from found join (select name, x, y from points_xy) p using (name)) r"""))
def _(spark, sf_dir):
    report = coordinate_report(v.points(spark, sf_dir), v.cells(spark, sf_dir))
    metres = ["community_x", "community_y", "exact_x", "exact_y"]
    return report.select("name", "south_north", "west_east", *[F.round(c, 3).alias(c) for c in metres], "planar_km", "sphere_km")
