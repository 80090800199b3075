"""Hour to day: missing values, gaps, levels, wind and the fused outputs."""

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from daygrid.catalog import CATALOG, DailyVariable
from daygrid.functions.aggregates import KINDS, present
from daygrid.operators.daily import complete_days, daily_long, daily_outputs, daily_wide, time_axis, to_long
from tests.conftest import rows

NAN = float("nan")


def hours(spark, values, var="T2", day=1):
    data = [(datetime(2020, 1, day, h), c // 10, c % 10, v) for c, vs in values.items() for h, v in enumerate(vs)]
    return spark.createDataFrame(data, f"time timestamp_ntz, south_north int, west_east int, {var} double")


def kind(name):
    return DailyVariable(name, "T2", name, 0.0, "", "", "", "")


def test_missing_values_are_skipped(spark):
    h = hours(spark, {0: [1.0, NAN, 3.0], 1: [NAN, NAN], 2: [None, 5.0]})
    out = daily_wide(h, [kind(k) for k in ("mean", "min", "max", "sum")])
    assert rows(out, "west_east", "mean", "min", "max", "sum") == [
        (0, 2.0, 1.0, 3.0, 4.0), (1, None, None, None, 0.0), (2, 5.0, 5.0, 5.0, 5.0),
    ]


@pytest.mark.parametrize("angles, want", [([350.0, 10.0, 0.0], 0.0), ([90.0, 90.0], 90.0), ([350.0, 340.0], 345.0), ([NAN, 10.0], 10.0)])
def test_circular_mean(spark, angles, want):
    out = daily_wide(hours(spark, {0: angles}, "wdir10"), ["wdir10_mean"]).first().wdir10_mean
    assert 0 <= out < 360
    assert min(abs(out - want), 360 - abs(out - want)) < 1e-9


def test_days_are_calendar_days_without_zone(spark):
    data = [(datetime(2020, 3, 8, 23, 59), 0, 0, 1.0), (datetime(2020, 3, 9), 0, 0, 2.0)]
    h = spark.createDataFrame(data, "time timestamp_ntz, south_north int, west_east int, T2 double")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Anchorage")
        assert rows(daily_wide(h, [kind("sum")]), "time", "sum") == [(date(2020, 3, 8), 1.0), (date(2020, 3, 9), 2.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_celsius_shift(spark):
    out = daily_wide(hours(spark, {0: [273.15, 275.15]}), ["t2_mean", "t2_min", "t2_max"]).first()
    assert (round(out.t2_mean, 9), round(out.t2_min, 9), round(out.t2_max, 9)) == (1.0, 0.0, 2.0)


def test_gap_day(spark):
    h = hours(spark, {0: [1.0], 1: [2.0]}).unionByName(hours(spark, {0: [4.0]}, day=3))
    daily = daily_wide(h, [kind("sum")])
    assert daily.count() == 3
    full = complete_days(daily)
    assert rows(full.where("west_east = 0"), "time", "sum") == [
        (date(2020, 1, 1), 1.0), (date(2020, 1, 2), None), (date(2020, 1, 3), 4.0),
    ]
    assert full.count() == 6
    axis = time_axis(h)
    assert axis.spans == [(date(2020, 1, 1), date(2020, 1, 3))] and axis.levels == (None,)
    cells = daily.select("south_north", "west_east").distinct()
    assert rows(complete_days(daily, span=axis.spans[0], cells=cells)) == rows(full)


def test_levels_are_grouped_apart(spark):
    data = [
        (datetime(2020, 1, 1, h), level, 0, 0, 280.0 + h if level is None else None, 10.0 * (level or 0) + h)
        for h in range(3) for level in (None, 1, 2)
    ]
    h = spark.createDataFrame(data, "time timestamp_ntz, level int, south_north int, west_east int, T2 double, temp double")
    names = ["t2_max", "temp_mean", "temp_max"]
    mixed = to_long(daily_wide(h, names), names)
    out = daily_outputs(h, names)
    assert rows(mixed, "variable", "level", "value") == rows(out, "variable", "level", "value")
    assert [(v, n, round(x, 6)) for v, n, x in rows(out, "variable", "level", "value")] == [
        ("t2_max", None, 8.85), ("temp_max", 1, 12.0), ("temp_max", 2, 22.0), ("temp_mean", 1, 11.0), ("temp_mean", 2, 21.0),
    ]
    assert time_axis(h).levels == (None, 1, 2)
    assert rows(daily_wide(h, ["t2_max"]), "level") == [(None,)]
    assert rows(daily_wide(h, ["temp_max"]), "level") == [(1,), (2,)]
    own = DailyVariable("own_max", "T2", "max", 0.0, "", "", "", "", levelled=True)
    assert rows(daily_outputs(h, [own]), "level", "value") == [(1, None), (2, None)]


def test_long_and_wide_agree(spark):
    h = hours(spark, {0: [1.0, 2.0, NAN], 7: [3.0]}).withColumn("rainnc", F.col("T2") * 2)
    names = ["t2_mean", "t2_min", "rainnc_sum"]
    observations = h.unpivot(["time", "south_north", "west_east"], ["T2", "rainnc"], "var_id", "value")
    wide = to_long(daily_wide(h, names), names)
    long = daily_long(observations, names)
    order = ["variable", "time", "south_north", "west_east", "value"]
    assert rows(wide, *order) == rows(long, *order)


def test_properties(spark, sf_dir):
    h = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("ts").alias("time"), (F.col("user_id") % 7).cast("int").alias("south_north"), F.lit(0).alias("west_east"), F.col("value").alias("T2")
    )
    out = daily_wide(h, [kind(k) for k in ("min", "mean", "max", "sum")])
    assert out.where("min > mean + 1e-9 or mean > max + 1e-9").count() == 0
    total = h.agg(F.sum("T2")).first()[0]
    assert abs(out.agg(F.sum("sum")).first()[0] - total) < 1e-6 * total


def test_user_aggregates(spark):
    h = hours(spark, {0: [1.0, 4.0, 9.0]})

    @F.pandas_udf("double")
    def middle(v: pd.Series) -> float:
        return float(v.median())

    spread = {"spread": lambda v: F.max(present(v)) - F.min(present(v))}
    assert daily_wide(h, [kind("spread"), kind("mean")], kinds=spread).first().spread == 8.0
    assert daily_wide(h, [kind("middle")], kinds={"middle": middle}).first().middle == 4.0
    with pytest.raises(ValueError, match="spread"):
        daily_wide(h, [kind("spread")])


def test_single_precision_is_reduced_in_double(spark):
    h = hours(spark, {0: [16777216.0, 1.0, 1.0]}).withColumn("T2", F.col("T2").cast("float"))
    out = daily_wide(h, [kind(k) for k in ("sum", "mean", "max")])
    assert {t for n, t in out.dtypes if n in ("sum", "mean", "max")} == {"double"}
    assert out.first()["sum"] == 16777218.0


def test_missing_source_column(spark):
    with pytest.raises(ValueError, match="rainnc"):
        daily_wide(hours(spark, {0: [1.0]}), ["t2_mean", "rainnc_sum"])


def test_every_kind_of_the_catalogue_has_a_builder():
    assert {e.agg_kind for e in CATALOG.values()} == set(KINDS)


def test_hot_cell_collapses_before_the_shuffle(spark):
    """Half of the rows in one cell: tasks reduce their rows before anything is shuffled."""
    h = spark.range(40000).select(
        F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz").alias("time"), F.lit(0).alias("south_north"),
        F.when(F.col("id") % 2 == 0, 0).otherwise((F.col("id") % 50).cast("int")).alias("west_east"),
        F.col("id").cast("double").alias("T2"),
    )
    out = daily_wide(h, [kind("sum")])
    assert out.count() == 26
    from tests.conftest import plan

    text = plan(out)
    assert text.index("Exchange") < text.index("partial_sum")
