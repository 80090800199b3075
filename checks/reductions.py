"""Aggregations (A), the whole catalogue (E) and user aggregates (U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.base import check
from checks.joins import _CELL_DAY, _REQUESTS, _WORK, cell_days, expected_units, existing_years, requests
from checks.scans import FILE_VIEW, file_vars
from checks.views import with_views
from daygrid import catalog as cat
from daygrid.catalog import CATALOG, DailyVariable, source_variables
from daygrid.functions.aggregates import present
from daygrid.operators import audit, yearly
from daygrid.operators.compare import best_offset, offset_differences
from daygrid.operators.daily import complete_days, daily_long, daily_outputs
from daygrid.operators.nearest import neighbourhood
from daygrid.plans.produce import produce
from daygrid.sizing import shared_folder

_DAY = "cast(cast(time as date) as varchar) as day, south_north, west_east"


def daily_rows(df, *more):
    """Daily output with the day as text and rounded values."""
    return df.select(F.col("time").cast("string").alias("day"), "south_north", "west_east", *more, F.round("value", 6).alias("value"))


def _of(entry_name, kind, shift=0.0):
    """A daily output of every source variable of the observations."""
    return [DailyVariable(f"{s}_{entry_name}", s, kind, shift, "", "", "", "") for s in v.EVENT_VARIABLES.values()]


def _each(name, sql_aggregate):
    return with_views(f"select {_DAY}, concat(var_id, '_{name}') as variable, round({sql_aggregate}, 6) as value from obs group by cast(time as date), south_north, west_east, var_id")


@check("a1_daily_mean", _each("mean", "avg(value)"))
def _(spark, sf_dir):
    return daily_rows(daily_long(v.obs(spark, sf_dir), _of("mean", "mean")), "variable")


@check("a2_daily_min", _each("min", "min(value)"))
def _(spark, sf_dir):
    return daily_rows(daily_long(v.obs(spark, sf_dir), _of("min", "min")), "variable")


@check("a3_daily_max", _each("max", "max(value)"))
def _(spark, sf_dir):
    return daily_rows(daily_long(v.obs(spark, sf_dir), _of("max", "max")), "variable")


@check("a4_daily_sum", with_views(f"""
select {_DAY}, concat(var_id, '_sum') as variable, round(coalesce(sum(value), 0), 6) as value
from obs_gaps group by cast(time as date), south_north, west_east, var_id"""))
def _(spark, sf_dir):
    """Sums over data with gaps: a day with hours but no value sums to 0."""
    return daily_rows(daily_long(v.obs_gaps(spark, sf_dir), _of("sum", "sum")), "variable")


@check("a5_daily_celsius", with_views(" union all ".join(
    f"select {_DAY}, 't2_{k}' as variable, round({f}(value) - 273.15e0, 6) as value from obs where var_id = 'T2' group by cast(time as date), south_north, west_east"
    for k, f in [("mean", "avg"), ("min", "min"), ("max", "max")]
)))
def _(spark, sf_dir):
    return daily_rows(daily_long(v.obs(spark, sf_dir), ["t2_mean", "t2_min", "t2_max"]), "variable")


def _circular(value):
    return f"(degrees(atan2(avg(sin(radians({value}))), avg(cos(radians({value}))))) + 360) % 360"


@check("a6_circular_mean", with_views(f"""
select {_DAY}, 'wdir10_mean' as variable, round({_circular('value')}, 6) as value from wind group by cast(time as date), south_north, west_east"""))
def _(spark, sf_dir):
    return daily_rows(daily_long(v.wind(spark, sf_dir), ["wdir10_mean"]), "variable")


_SIX = ["t2_mean", "t2_min", "t2_max", "rainnc_sum", "wspd10_max", "rh2_mean"]
_SQL_KIND = {"mean": "avg({})", "min": "min({})", "max": "max({})", "sum": "coalesce(sum({}), 0)"}


@check("a7_fused_outputs", with_views(" union all ".join(
    f"select {_DAY}, '{n}' as variable, round({_SQL_KIND[CATALOG[n].agg_kind].format(CATALOG[n].var_id)} + cast('{CATALOG[n].offset}' as double), 6) as value "
    "from hourly group by cast(time as date), south_north, west_east"
    for n in _SIX
)))
def _(spark, sf_dir):
    return daily_rows(daily_outputs(v.hourly(spark, sf_dir), _SIX), "variable")


def _catalog_sql(entry):
    value = f"(value + {v.SOURCES.index(entry.var_id)})"
    kinds = {**_SQL_KIND, "circular_mean": _circular("{}")}
    aggregate = kinds[entry.agg_kind].replace("{}", value)
    level = "is not null" if entry.dims == 3 else "is null"
    return (
        f"select {_DAY}, coalesce(level, -1) as level, '{entry.name}' as variable, round({aggregate} + cast('{entry.offset}' as double), 6) as value "
        f"from hourly_all where level {level} group by cast(time as date), south_north, west_east, level"
    )


@check("e_full_catalogue", with_views("\nunion all ".join(_catalog_sql(e) for e in CATALOG.values())))
def _(spark, sf_dir):
    """All 68 daily outputs of all 43 source variables, with levels."""
    return daily_rows(daily_outputs(v.hourly_all(spark, sf_dir), CATALOG), F.coalesce("level", F.lit(-1)).alias("level"), "variable")


@check("u1_pluggable_aggregate", with_views(f"""
select variable, cast(year(c.time) as integer) as year, cast(c.time as varchar) as day, y_idx, x_idx, round(value, 6) as value
from (select unnest({[f"{x}_spread" for x in v.EVENT_VARIABLES.values()] + ["rainnc_sum"]}) as variable) n cross join event_calendar c cross join event_map m
left join made d using (variable, time, south_north, west_east)""",
    {"made": f"""made as (select concat(var_id, '_spread') as variable, cast(time as date) as time, south_north, west_east, max(value) - min(value) as value from obs group by all
  union all select 'rainnc_sum', cast(time as date), south_north, west_east, coalesce(sum(value) filter (var_id = 'rainnc'), 0) from obs group by all)"""}))
def _(spark, sf_dir):
    """Aggregates of the user's own for all variables, next to one of the catalogue, written as a product and read back."""
    spread = [DailyVariable(f"{x}_spread", x, "spread", 0.0, "", "", "", "") for x in v.EVENT_VARIABLES.values()]
    kinds = {"spread": lambda c: F.max(present(c)) - F.min(present(c))}
    rows = v.grid_rows(spark, sf_dir, "events", "user_id")
    made = produce(v.hourly(spark, sf_dir), [*spread, "rainnc_sum"], 2024, 2024, v.model_grid(rows), v.target_grid(rows), shared_folder(spark), kinds=kinds)
    return made.select("variable", "year", F.col("time").cast("string").alias("day"), "y_idx", "x_idx", F.round("value", 6).alias("value"))


@check("n3_complete_days", with_views("""
select cast(cast(f.time as date) as varchar) as day, f.south_north, f.west_east, f.variable, round(d.value, 6) as value
from (select c.south_north, c.west_east, c.variable, t.range as time from (select distinct south_north, west_east, variable from sums) c,
  range((select min(time) from sums), (select max(time) from sums) + interval 1 day, interval 1 day) t) f
left join sums d on d.south_north = f.south_north and d.west_east = f.west_east and d.variable = f.variable and d.time = cast(f.time as date)""",
    {"sums": "sums as (select cast(time as date) as time, south_north, west_east, concat(var_id, '_sum') as variable, coalesce(sum(value), 0) as value from obs group by all)"}))
def _(spark, sf_dir):
    return daily_rows(complete_days(daily_long(v.obs(spark, sf_dir), _of("sum", "sum"))), "variable")


# --- years ---------------------------------------------------------------


@check("a8_annual_statistics", with_views("""
select south_north, west_east, cast(year(time) as integer) as year, round(avg(value), 6) as annual_mean,
  round(sum(value), 6) as annual_sum, min(value) as annual_min, max(value) as annual_max from days group by 1, 2, 3"""))
def _(spark, sf_dir):
    a = yearly.annual(v.days(spark, sf_dir), ["south_north", "west_east"], ["mean", "sum", "min", "max"])
    return a.withColumns({c: F.round(c, 6) for c in ["annual_mean", "annual_sum"]})


_RULE = "(contains(variable, 'sum') or contains(variable, 'rain'))"
_ANNUAL = {
    "annuals": f"""annuals as (select variable, y_idx, x_idx, year, case when {_RULE} then sum(value) else avg(value) end as value,
  case when {_RULE} then 'Total Annual' when contains(variable, 'min') then 'Mean Annual Daily Minimum'
    when contains(variable, 'max') then 'Mean Annual Daily Maximum' else 'Mean Annual' end as tag from fields group by variable, y_idx, x_idx, year)""",
}
_LINE = """cast(count(value) as integer) as years, round(regr_slope(value, year), 6) as slope, round(10 * regr_slope(value, year), 6) as per_decade,
  round(regr_intercept(value, year), 6) as intercept, round(avg(value), 6) as mean"""


def annuals(spark, sf_dir):
    return yearly.annual_by_rule(v.fields(spark, sf_dir), ["y_idx", "x_idx"])


@check("a9_annual_rule", with_views("select variable, y_idx, x_idx, year, round(value, 6) as value, tag from annuals", _ANNUAL))
def _(spark, sf_dir):
    return annuals(spark, sf_dir).withColumn("value", F.round("value", 6))


@check("a10_pivot", with_views("select year, variable, y_idx, " + ", ".join(
    f"round(max(value) filter (where x_idx = {i}), 6) as p{i}" for i in range(10)
) + " from annuals group by year, variable, y_idx", _ANNUAL))
def _(spark, sf_dir):
    """Years as rows, the ten cells of a grid row as columns."""
    named = annuals(spark, sf_dir).withColumn("point", F.concat(F.lit("p"), F.col("x_idx")))
    names = [f"p{i}" for i in range(10)]
    wide = yearly.pivot_years(named, "point", names, ["variable", "y_idx"])
    return wide.withColumns({n: F.round(n, 6) for n in names})


@check("a11_trend", with_views(f"select variable, y_idx, x_idx, {_LINE} from annuals group by variable, y_idx, x_idx", _ANNUAL))
def _(spark, sf_dir):
    t = yearly.trend(annuals(spark, sf_dir), ["variable", "y_idx", "x_idx"])
    return t.withColumns({c: F.round(c, 6) for c in ["slope", "per_decade", "mean", "intercept"]})


@check("a12_long_term_mean", with_views("select variable, y_idx, x_idx, round(avg(value), 6) as mean from annuals group by variable, y_idx, x_idx", _ANNUAL))
def _(spark, sf_dir):
    return yearly.trend(annuals(spark, sf_dir), ["variable", "y_idx", "x_idx"]).select(
        "variable", "y_idx", "x_idx", F.round("mean", 6).alias("mean")
    )


PERIODS = ((1995, 1997), (1998, 2001))


@check("a13_normals", with_views("""
select south_north, west_east, cast(dayofyear(time) as integer) as dayofyear, round(avg(value), 6) as normal
from days where year(time) between 1995 and 1997 group by 1, 2, 3"""))
def _(spark, sf_dir):
    n = yearly.normals(v.days(spark, sf_dir), ["south_north", "west_east"], PERIODS[0])
    return n.withColumn("normal", F.round("normal", 6))


@check("a14_two_periods", with_views("""
select south_north, west_east, cast(dayofyear(time) as integer) as dayofyear,
  round(avg(value) filter (where year(time) between 1995 and 1997), 6) as normal_1,
  round(avg(value) filter (where year(time) between 1998 and 2001), 6) as normal_2
from days where year(time) between 1995 and 2001 group by 1, 2, 3"""))
def _(spark, sf_dir):
    n = yearly.normals_two_periods(v.days(spark, sf_dir), ["south_north", "west_east"], PERIODS)
    return n.withColumns({c: F.round(c, 6) for c in ["normal_1", "normal_2"]})


_STATE = ["south_north", "west_east"]


@check("a14_normals_from_state", with_views("""
select south_north, west_east, cast(dayofyear(time) as integer) as dayofyear,
  round(avg(value) filter (where year(time) between 1994 and 1996), 6) as normal_1,
  round(avg(value) filter (where year(time) between 1996 and 2005), 6) as normal_2,
  round(avg(value) filter (where year(time) = 1997), 6) as normal_3
from days where year(time) >= 1994 group by 1, 2, 3"""))
def _(spark, sf_dir):
    """The stored state of all years, and three periods from it: no day is read a second time."""
    path = shared_folder(spark)
    yearly.write_normals_state(yearly.normals_state(v.days(spark, sf_dir), _STATE), path)
    n = yearly.normals_from_state(spark.read.parquet(path), _STATE, [(1994, 1996), (1996, 2005), (1997, 1997)])
    return n.withColumns({f"normal_{i}": F.round(f"normal_{i}", 6) for i in (1, 2, 3)})


# --- differences ---------------------------------------------------------

_PAIRS = {
    **_CELL_DAY,
    "offsets": "offsets as (select cast(a.range as integer) - 1 as di, cast(b.range as integer) - 1 as dj from range(3) a, range(3) b)",
    "neighbours": """neighbours as (select c.south_north as row, c.west_east as col, di, dj,
  greatest(0, least(c.south_north + dj, ny - 1)) as south_north, greatest(0, least(c.west_east + di, 9)) as west_east
  from cells c, offsets, domain)""",
    "cell_mads": """cell_mads as (select n.row, n.col, n.south_north, n.west_east, avg(abs(b.value - a.value)) as mad
  from (select distinct row, col, south_north, west_east from neighbours) n
  join cell_days a on a.south_north = n.south_north and a.west_east = n.west_east
  join cell_days b on b.south_north = n.row and b.west_east = n.col and b.time = a.time group by all)""",
    "mads": "mads as (select * from neighbours join cell_mads using (row, col, south_north, west_east))",
}


def neighbour_differences(spark, sf_dir):
    """Mean absolute difference between each cell's series and those of its neighbours."""
    series = cell_days(spark, sf_dir)
    grid = v.cells(spark, sf_dir).select(
        "south_north", "west_east", F.col("south_north").alias("row"), F.col("west_east").alias("col")
    )
    around = neighbourhood(grid, v.grid_rows(spark, sf_dir), v.WIDTH)
    own = series.withColumnsRenamed({"south_north": "row", "west_east": "col"})
    return offset_differences(around, series, own, ["row", "col"]).drop("south_north", "west_east")


@check("a15_mean_abs_difference", with_views('select "row", col, di, dj, round(mad, 8) as mad from mads', _PAIRS))
def _(spark, sf_dir):
    return neighbour_differences(spark, sf_dir).withColumn("mad", F.round("mad", 8))


@check("a16_best_offset", with_views("""
select "row", col, di, dj, round_even(mad, 2) as mad from (
  select *, row_number() over (partition by "row", col order by mad, di, dj) as place from mads where di <> 0 or dj <> 0) r where place = 1""", _PAIRS))
def _(spark, sf_dir):
    """The neighbour, other than the cell itself, that agrees best."""
    others = neighbour_differences(spark, sf_dir).where((F.col("di") != 0) | (F.col("dj") != 0))
    return best_offset(others, ["row", "col"])


# --- audits --------------------------------------------------------------


@check("a17_variable_sets", with_views("""
select variables, count(*) as files, min(path) as example, min(path) = (select min(path) from sets) as is_baseline from sets group by variables""", FILE_VIEW))
def _(spark, sf_dir):
    groups = audit.set_groups(audit.variable_sets(file_vars(spark, sf_dir)))
    return groups.withColumn("variables", F.array_join("variables", ","))


@check("a18_consistency", with_views("""
select count(*) as files, count(distinct variables) as variable_sets, count(distinct variables) = 1 as consistent from sets""", FILE_VIEW))
def _(spark, sf_dir):
    return audit.consistency(audit.variable_sets(file_vars(spark, sf_dir)))


@check("a19_completion", with_views("""
select variable, count(*) as expected, count(x.year) as existing, count(*) - count(x.year) as missing,
  round(100.0e0 * count(x.year) / count(*), 6) as rate
from expected left join existing x using (year) group by variable""", _WORK))
def _(spark, sf_dir):
    done = audit.completion(expected_units(spark, sf_dir), existing_years(spark, sf_dir), ["variable"], ["year"])
    return done.withColumn("rate", F.round("rate", 6))


@check("a20_source_variables", with_views("select distinct var_id from requests join catalog using (name)", _REQUESTS))
def _(spark, sf_dir):
    return cat.with_catalog(requests(spark, sf_dir), on="name").select("var_id").distinct()


assert len(source_variables(CATALOG)) == 43
