"""Scans, sources and sinks (S) and the row-wise operators (P)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import views as v
from checks.base import check, num
from checks.views import with_views
from daygrid import catalog as cat
from daygrid.functions.aggregates import present
from daygrid.functions.units import to_celsius
from daygrid.grids import clamp, grid_axes
from daygrid.operators.daily import daily_long, daily_wide
from daygrid.operators.yearly import within_years
from daygrid.sizing import shared_folder
from daygrid.sources import hourly as src
from daygrid.sources import logs, product

# One output of each observed variable.
SHORT = ["t2_mean", "seaice_max", "rainnc_sum", "rh2_mean", "wspd10_max"]
# A time of day as text, in Spark and in SQL.
HOUR = "yyyy-MM-dd HH:mm:ss"
_HOUR = "strftime(time, '%Y-%m-%d %H:%M:%S') as time"

# Catalogue rows as a SQL relation.
_VALUES = ",\n".join(
    f"({i}, '{e.name}', '{e.var_id}', '{e.short_name}', '{e.standard_name}', '{e.units}', '{e.agg_kind}', "
    f"'{e.description}', {repr(e.cell_methods) if e.cell_methods else 'null'}, {num(e.offset)}, {e.dims})"
    for i, e in enumerate(cat.CATALOG.values())
)
CATALOG_VIEW = {
    "catalog": f"""catalog as (select * from (values {_VALUES})
  c(pos, name, var_id, short_name, standard_name, units, agg_kind, description, cell_methods, shift, dims))"""
}


@check("s1_year_scan", with_views("""
select strftime(time, '%Y-%m-%d %H:%M:%S') as hour, south_north, west_east, T2, rainnc from years_hourly where year = 1996"""))
def _(spark, sf_dir):
    """One year of a table that is partitioned by year."""
    root = shared_folder(spark)
    v.years_hourly(spark, sf_dir).write.partitionBy("year").parquet(root)
    rows = src.read_years(spark, root, 1996)
    return rows.select(F.date_format("time", HOUR).alias("hour"), "south_north", "west_east", "T2", "rainnc")


@check("s2_column_pruned_read", with_views(f"select {_HOUR}, south_north, west_east, year, T2 from years_hourly"))
def _(spark, sf_dir):
    return src.for_outputs(v.years_hourly(spark, sf_dir), ["t2_mean", "t2_max"]).withColumn("time", F.date_format("time", HOUR))


@check("s3_batched_append", with_views(f"select {_HOUR}, south_north, west_east, var_id, value from obs"))
def _(spark, sf_dir):
    o = v.obs(spark, sf_dir)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    both = src.append_in_time([o.where(F.col("time") < middle), o.where(F.col("time") >= middle)])
    return both.withColumn("time", F.date_format("time", HOUR))


@check("s4_combine_by_coords", with_views(f"""
select {_HOUR}, south_north, west_east, var_id, count(*) as copies from (
  select * from obs where time < timestamp '2024-01-20' union all select * from obs where time >= timestamp '2024-01-12') o
group by all having count(*) > 1"""))
def _(spark, sf_dir):
    """Two batches that have eight days in common, and a third, later one that has none."""
    root, o = shared_folder(spark), v.obs(spark, sf_dir)
    late = F.lit("2024-01-25").cast("timestamp_ntz")
    first, second = o.where(F.col("time") < F.lit("2024-01-20").cast("timestamp_ntz")), o.where(F.col("time") >= F.lit("2024-01-12").cast("timestamp_ntz"))
    for name, batch in (("a", first), ("b", second.where(F.col("time") < late)), ("c", second.where(F.col("time") >= late))):
        batch.write.parquet(f"{root}/{name}")
    twice = src.overlapping_hours(spark.read.parquet(*[f"{root}/{name}" for name in "abc"]))
    return twice.withColumn("time", F.date_format("time", HOUR))


def _written_fields(spark, sf_dir):
    """The folder of a product with the fields of the tables."""
    root = shared_folder(spark)
    placed = v.fields(spark, sf_dir).withColumns({"y": F.col("y_idx").cast("double"), "x": F.col("x_idx").cast("double")})
    product.write_fields(placed, root)
    return root


@check("s5_variable_all_years", with_views("select year, y_idx, x_idx, value from fields where variable = 'rainnc_sum'"))
def _(spark, sf_dir):
    fields = product.read_product(spark, _written_fields(spark, sf_dir), ["rainnc_sum"])
    return fields.select("year", "y_idx", "x_idx", "value")


@check("s12_unit_open", with_views("""
select cast(time as varchar) as day, y_idx, x_idx, value from fields where variable = 't2_mean' and year = 1997"""))
def _(spark, sf_dir):
    unit = product.read_product(spark, _written_fields(spark, sf_dir), ["t2_mean"], (1997, 1997))
    return unit.select(F.col("time").cast("string").alias("day"), "y_idx", "x_idx", "value")


_EAST, _NORTH = v.sql_stereo(num(-152.0), num(64.0))


@check("s8_catalogue", with_views("""
select name, var_id, short_name, standard_name, units, agg_kind, description, cell_methods, shift, dims, n
from (select var_id, count(*) as n from obs group by var_id) o join catalog using (var_id)""", CATALOG_VIEW))
def _(spark, sf_dir):
    seen = v.obs(spark, sf_dir).groupBy("var_id").agg(F.count(F.lit(1)).alias("n"))
    return cat.with_catalog(seen).drop("position").withColumnRenamed("offset", "shift")


def _small_product(spark, sf_dir):
    """Daily values of all variables as product rows on the source cells."""
    long = daily_long(v.obs(spark, sf_dir), SHORT)
    return long.select(
        "time", F.lit(None).cast("int").alias("level"),
        F.col("south_north").alias("y_idx"), F.col("west_east").alias("x_idx"),
        F.col("south_north").cast("double").alias("y"), F.col("west_east").cast("double").alias("x"),
        "value", "variable", F.year("time").alias("year"),
    )


_SQL_KIND = {"mean": "avg(value)", "max": "max(value)", "sum": "coalesce(sum(value), 0)"}
_SMALL = "small as (" + " union all ".join(
    f"select '{n}' as variable, cast(time as date) as day, south_north, west_east, {_SQL_KIND[cat.CATALOG[n].agg_kind]} + {num(cat.CATALOG[n].offset)} as value "
    f"from obs where var_id = '{cat.CATALOG[n].var_id}' group by cast(time as date), south_north, west_east"
    for n in SHORT
) + ")"
_PRODUCT_ROW = "variable, cast(year(day) as integer) as year, cast(day as varchar) as day, south_north as y_idx, west_east as x_idx"


def _product_rows(df):
    return df.select("variable", "year", F.col("time").cast("string").alias("day"), "y_idx", "x_idx", F.round("value", 6).alias("value"))


@check("s9_product_sink", with_views(f"select {_PRODUCT_ROW}, round(value, 6) as value from small", {"small": _SMALL}))
def _(spark, sf_dir):
    root = shared_folder(spark)
    product.write_fields(_small_product(spark, sf_dir), root)
    return _product_rows(product.read_product(spark, root, SHORT, (2024, 2024)))


@check("s10_write_guard", with_views(f"""
select {_PRODUCT_ROW}, round(case when variable = 'rainnc_sum' then 2 * value else value end, 6) as value from small""", {"small": _SMALL}))
def _(spark, sf_dir):
    """Write units, be refused one of them, then replace that one: the others stay."""
    root = shared_folder(spark)
    rows = _small_product(spark, sf_dir)
    product.write_fields(rows, root)
    try:
        product.check_free(spark, root, ["rainnc_sum"], 2024, 2024)
        raise AssertionError("existing output was not refused")
    except FileExistsError:
        pass
    replaced = rows.where(F.col("variable") == "rainnc_sum").withColumn("value", F.col("value") * 2)
    product.write_fields(replaced, root)
    return _product_rows(product.read_product(spark, root))


PAGE_NAME = r"example\.\w+/(\w\w)/(\d+)"
PAGE_PHRASES = ('lang="en"', " was ")


def page_logs(spark, sf_dir):
    """Pages in the place of logs: the address is the path, language and number stand for variable and year."""
    return v.table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.col("html").alias("content"))


LOG_VIEW = {
    "page_logs": r"""page_logs as (select url as path, html as content, regexp_extract(url, 'example\.\w+/(\w\w)/(\d+)', 1) as variable,
  try_cast(regexp_extract(url, 'example\.\w+/(\w\w)/(\d+)', 2) as bigint) as year from pages)"""
}


@check("s11_log_scan", with_views("""
select path, variable, year, length(content) as characters from page_logs where variable <> '' and year is not null""", LOG_VIEW))
def _(spark, sf_dir):
    return logs.units_of(page_logs(spark, sf_dir), PAGE_NAME).select(
        "path", "variable", "year", F.length("content").cast("bigint").alias("characters")
    )


# --- row-wise operators --------------------------------------------------


@check("p1_select_variable", with_views("select south_north, west_east, wspd10 from hourly where wspd10 is not null"))
def _(spark, sf_dir):
    return v.hourly(spark, sf_dir).select("south_north", "west_east", "wspd10").where(F.col("wspd10").isNotNull())


@check("p2_rename", with_views("select south_north as y, west_east as x, T2 as t2 from hourly where T2 is not null"))
def _(spark, sf_dir):
    h = v.hourly(spark, sf_dir).select("south_north", "west_east", "T2").where(F.col("T2").isNotNull())
    return h.withColumnsRenamed({"south_north": "y", "west_east": "x", "T2": "t2"})


@check("p3_assign_coords", with_views(f"""
select south_north, west_east, lat, lon,
  round({_EAST} - {num(900000.0)} + west_east * {num(200000.0)}, 2) as x,
  round({_NORTH} - (ny - 1) / 2.0e0 * ({num(2000000.0)} / ny) + south_north * ({num(2000000.0)} / ny), 2) as y from cells, domain"""))
def _(spark, sf_dir):
    grid = v.model_grid(v.grid_rows(spark, sf_dir))
    return v.cells(spark, sf_dir).withColumns({
        "x": F.round(grid.x.centre(F.col("west_east")), 2), "y": F.round(grid.y.centre(F.col("south_north")), 2)
    })


@check("p4_drop_aux", with_views("select south_north, west_east from cells"))
def _(spark, sf_dir):
    return v.cells(spark, sf_dir).drop("lat", "lon")


_FILE_VARIABLE = f"case when event_type in ('click', 'view') then {v.sql_case('event_type', v.EVENT_VARIABLES)} else event_type end"


def file_vars(spark, sf_dir):
    """Which "file" (user and day) holds which variable."""
    return v.table(spark, sf_dir, "events").select(
        F.concat_ws("_", F.lit("f"), F.col("user_id"), F.to_date("ts")).alias("path"), F.col("event_type").alias("variable")
    )


FILE_VIEW = {
    "file_vars": "file_vars as (select concat('f_', user_id, '_', cast(ts as date)) as path, event_type as variable from events)",
    "sets": """sets as (select path, string_agg(variable, ',' order by variable) as variables
  from (select distinct path, variable from file_vars) d group by path)""",
}


@check("p5_unknown_variables", with_views(f"""
select variable, count(*) as n from (select {_FILE_VARIABLE} as variable from events) e
where variable not in (select var_id from catalog) group by variable""", CATALOG_VIEW))
def _(spark, sf_dir):
    known = F.when(F.col("event_type").isin("click", "view"), v.event_variable()).otherwise(F.col("event_type"))
    names = v.table(spark, sf_dir, "events").select(known.alias("variable"))
    return cat.unknown_names(names, "variable", against="var_id").groupBy("variable").agg(F.count(F.lit(1)).alias("n"))


@check("p6_period_filter", with_views("""
select cast(time as varchar) as day, south_north, west_east, value from days where year(time) between 1996 and 1998"""))
def _(spark, sf_dir):
    rows = v.days(spark, sf_dir).where(within_years("time", 1996, 1998))
    return rows.withColumn("day", F.col("time").cast("string")).drop("time")


@check("p7_not_nan_mask", with_views("select var_id, count(*) as n, round(sum(value), 4) as total from obs_gaps where value is not null group by var_id"))
def _(spark, sf_dir):
    kept = v.obs_gaps(spark, sf_dir).where(present(F.col("value")).isNotNull())
    return kept.groupBy("var_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@check("p8_kelvin_shift", with_views("""
select cast(cast(time as date) as varchar) as day, south_north, west_east,
  round(avg(value) - 273.15e0, 6) as t2_mean, round(min(value) - 273.15e0, 6) as t2_min, round(max(value) - 273.15e0, 6) as t2_max
from obs where var_id = 'T2' group by all"""))
def _(spark, sf_dir):
    temperatures = v.hourly(spark, sf_dir).where(F.col("T2").isNotNull())
    out = daily_wide(temperatures, ["t2_mean", "t2_min", "t2_max"])
    return out.select(
        F.col("time").cast("string").alias("day"), "south_north", "west_east",
        *[F.round(c, 6).alias(c) for c in ["t2_mean", "t2_min", "t2_max"]],
    )


_UNITS = {"click": "K", "error": "kelvin", "purchase": "degC", "signup": "furlong", "view": "Degree_C"}


@check("p9_unit_conversion", with_views(f"""
select event_id,
  round(value - case when upper(unit) in ('K', 'KELVIN') then 273.15e0 when lower(unit) in ('degree_c', 'degc', 'celsius', 'c', 'degrees_celsius') then 0 else 273.15e0 end, 6) as as_source,
  round(value - case when upper(unit) in ('K', 'KELVIN') then 273.15e0 else 0 end, 6) as as_product
from (select event_id, value, {v.sql_case('event_type', _UNITS)} as unit from events) e"""))
def _(spark, sf_dir):
    unit = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(u)) for k, u in _UNITS.items()])
    return v.table(spark, sf_dir, "events").select(
        "event_id",
        F.round(to_celsius(F.col("value"), unit, "kelvin"), 6).alias("as_source"),
        F.round(to_celsius(F.col("value"), unit, "unchanged"), 6).alias("as_product"),
    )


_LEVELLED = ", ".join(f"'{s}'" for s in sorted(cat.LEVELLED_SOURCES))
# Event types stand for variables with and without a level here.
_DIMS = {"click": "T2", "error": "temp", "purchase": "rainnc", "signup": "SMOIS", "view": "u"}


@check("p10_dims_class", with_views(f"""
select var_id, var_id in ({_LEVELLED}) as levelled, count(*) as n
from (select {v.sql_case('event_type', _DIMS)} as var_id from events) e group by all"""))
def _(spark, sf_dir):
    var_id = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(u)) for k, u in _DIMS.items()])
    seen = v.table(spark, sf_dir, "events").select(var_id.alias("var_id"))
    return seen.groupBy("var_id", cat.is_levelled(F.col("var_id")).alias("levelled")).agg(F.count(F.lit(1)).alias("n"))


@check("p11_cell_pick", with_views("""
select cast(time as varchar) as day, value from days where south_north = 0 and west_east = 7"""))
def _(spark, sf_dir):
    cell = v.days(spark, sf_dir).where((F.col("south_north") == 0) & (F.col("west_east") == 7))
    return cell.select(F.col("time").cast("string").alias("day"), "value")


@check("p12_clamp", with_views("""
select id, cast(greatest(0, least(floor(tx) - 5, 9)) as integer) as i, cast(greatest(0, least(floor(ty), ny - 1)) as integer) as j from tgt, domain"""))
def _(spark, sf_dir):
    rows = v.grid_rows(spark, sf_dir)
    return v.tgt(spark, sf_dir).select(
        "id", clamp(F.floor("tx") - 5, 10).cast("int").alias("i"), clamp(F.floor("ty"), rows).cast("int").alias("j")
    )


# What the source says of itself: the description and the projection do not hold for a daily product.
_INHERITED = {"stagger": "none", "projection": "source", "description": "hourly", "units": "source units"}


@check("p15_attributes", with_views("""
select name, description as long_name, units, standard_name, coalesce(cell_methods, 'unknown') as cell_methods, 'none' as stagger, 4 + 1 as n_attributes, n
from (select var_id, count(*) as n from hourly_names group by var_id) o join catalog using (var_id)""",
    {**CATALOG_VIEW, "hourly_names": f"hourly_names as (select {v.sql_case('event_type', _DIMS)} as var_id from events)"}))
def _(spark, sf_dir):
    """Attributes of the daily outputs of all variables of a table: the source's own under the catalogue's."""
    var_id = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(u)) for k, u in _DIMS.items()])
    seen = cat.with_catalog(v.table(spark, sf_dir, "events").groupBy(var_id.alias("var_id")).agg(F.count(F.lit(1)).alias("n")))
    merged = [(e.name, product.merge_attributes(_INHERITED, e)) for e in cat.CATALOG.values()]
    attributes = spark.createDataFrame(merged, "name string, attrs map<string,string>")
    a = F.col("attrs")
    return seen.select("name", "n").join(F.broadcast(attributes), "name").select(
        "name", *[a[k].alias(k) for k in ("long_name", "units", "standard_name", "cell_methods", "stagger")], F.size(a).alias("n_attributes"), "n"
    )


@check("p16_dataset_attributes", with_views("""
select variable, year, 'CF-1.8' as conventions, concat('Daily aggregated ', variable, ' on EPSG:3338') as title,
  '2024-02-01 00:00:00 UTC: Created with Spark' as history, 'example archive' as institution, 'T' as time_axis, n
from (""" + " union all ".join(f"select '{n}' as variable, cast(year(time) as integer) as year, count(*) as n from obs where var_id = '{cat.CATALOG[n].var_id}' group by year(time)" for n in SHORT) + ") u"))
def _(spark, sf_dir):
    """Attributes of the units that the observations give, next to their number of hours."""
    o = v.obs(spark, sf_dir)
    units = cat.with_catalog(o.groupBy("var_id", F.year("time").alias("year")).agg(F.count(F.lit(1)).alias("n")))
    units = units.where(F.col("name").isin(SHORT)).select(F.col("name").alias("variable"), "year", "n")
    grid = v.target_grid(v.grid_rows(spark, sf_dir))
    attributes = product.attributes_frame(
        spark, SHORT, [2024], grid, {"institution": "example archive"}, datetime(2024, 2, 1)
    )
    a = F.col("attrs")
    return units.join(F.broadcast(attributes), ["variable", "year"]).select(
        "variable", "year", a["Conventions"].alias("conventions"), a["title"].alias("title"), a["history"].alias("history"),
        a["institution"].alias("institution"), a["time_axis"].alias("time_axis"), "n",
    )


@check("p20_crs_tag", with_views("""
select variable, 'EPSG:3338' as crs, 'x' as x_dim, 'y' as y_dim, '12' as x_count, cast(ny + 2 as varchar) as y_count, n
from domain, (""" + " union all ".join(f"select '{n}' as variable, count(*) as n from obs where var_id = '{cat.CATALOG[n].var_id}'" for n in SHORT) + ") u"))
def _(spark, sf_dir):
    """The grid of each unit, as read back from the attributes that were written with it, next to its number of hours."""
    root = shared_folder(spark)
    grid = v.target_grid(v.grid_rows(spark, sf_dir))
    product.write_attributes(product.attributes_frame(spark, SHORT, [2024], grid), root)
    seen = cat.with_catalog(v.obs(spark, sf_dir).groupBy("var_id").agg(F.count(F.lit(1)).alias("n")))
    units = seen.select(F.col("name").alias("variable"), "n").join(product.read_attributes(spark, root), "variable")
    return units.select("variable", *[F.col("attrs")[k].alias(k) for k in ("crs", "x_dim", "y_dim", "x_count", "y_count")], "n")


_BOTH = " and ".join(f"contains(content, '{p}')" for p in PAGE_PHRASES)


@check("p18_timeout_predicate", with_views(f"select path, {_BOTH} as timed_out from page_logs", LOG_VIEW))
def _(spark, sf_dir):
    return page_logs(spark, sf_dir).select("path", logs.contains_all(F.col("content"), PAGE_PHRASES).alias("timed_out"))


@check("p19_output_validity", with_views("select variable, year, count(*) as rows from fields group by all"))
def _(spark, sf_dir):
    return product.valid_units(v.fields(spark, sf_dir))
