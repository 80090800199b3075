"""Annual statistics, trend, pivot and normals."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from daygrid.operators import yearly
from daygrid.operators.compare import align, best_offset, mean_abs_difference, offset_differences
from tests.conftest import plan, rows

NAN = float("nan")


def daily(spark, data):
    return spark.createDataFrame(data, "variable string, name string, time date, value double")


def test_rule_follows_the_name(spark):
    names = {
        "rainnc_sum": (6.0, "Total Annual"), "rain_total": (6.0, "Total Annual"), "sum_of_min": (6.0, "Total Annual"),
        "t2_min": (3.0, "Mean Annual Daily Minimum"), "minmax": (3.0, "Mean Annual Daily Minimum"),
        "t2_max": (3.0, "Mean Annual Daily Maximum"), "t2_mean": (3.0, "Mean Annual"),
    }
    data = [(v, "a", date(2000, 1, d), x) for v in names for d, x in [(1, 2.0), (2, 4.0), (3, NAN)]]
    out = {r.variable: (r.value, r.tag) for r in yearly.annual_by_rule(daily(spark, data), ["name"]).collect()}
    assert out == names


def test_annual_statistics_skip_missing(spark):
    data = [("v", "a", date(2000, 1, 1), 2.0), ("v", "a", date(2000, 5, 1), NAN), ("v", "a", date(2001, 1, 1), None)]
    out = yearly.annual(daily(spark, data), ["name"], ["mean", "sum", "min", "max"])
    assert rows(out.drop("name")) == [(2000, 2.0, 2.0, 2.0, 2.0), (2001, None, 0.0, None, None)]


def series(spark, data):
    return spark.createDataFrame(data, "name string, year int, value double")


def test_trend_needs_two_years(spark):
    s = series(spark, [("one", 2000, 5.0), ("one", 2001, NAN), ("two", 1, 1.0), ("two", 2, None), ("two", 3, 5.0), ("none", 1, None)])
    out = {r.name: r for r in yearly.trend(s, ["name"]).collect()}
    assert (out["one"].slope, out["one"].intercept, out["one"].mean) == (None, None, 5.0)
    assert (out["none"].slope, out["none"].mean, out["none"].years) == (None, None, 0)
    assert (out["two"].slope, out["two"].per_decade, out["two"].mean) == pytest.approx((2.0, 20.0, 3.0))
    fit = {(r.name, r.year): r.fitted for r in yearly.with_fit(s, ["name"]).collect()}
    assert [fit["two", y] for y in (1, 2, 3)] == pytest.approx([1.0, 3.0, 5.0])
    assert fit["one", 2000] is None and fit["one", 2001] is None
    assert len(fit) == 6


def test_pivot_has_all_names(spark):
    s = series(spark, [("a", 2000, 1.0), ("b", 2001, 2.0)])
    out = yearly.pivot_years(s, "name", ["b", "a", "c"])
    assert out.columns == ["year", "b", "a", "c"]
    assert rows(out) == [(2000, None, 1.0, None), (2001, 2.0, None, None)]


def test_day_of_year_is_not_adjusted_for_leap_years(spark):
    data = [("v", "a", d, float(d.year)) for d in (date(2023, 12, 31), date(2024, 12, 31), date(2024, 2, 29), date(2023, 3, 1))]
    out = yearly.normals(daily(spark, data), ["name"], (2023, 2024))
    assert rows(out, "dayofyear", "normal") == [(60, 2023.5), (365, 2023.0), (366, 2024.0)]


def test_periods_include_both_ends(spark):
    days = [date(y, m, d) for y in (1989, 1990) for m, d in ((1, 1), (12, 31))]
    data = daily(spark, [("v", "a", d, float(d.year)) for d in days])
    out = yearly.normals_two_periods(data, ["name"], ((1960, 1989), (1990, 2019)))
    assert rows(out.drop("name")) == [(1, 1989.0, 1990.0), (365, 1989.0, 1990.0)]
    hours = spark.createDataFrame([("1989-12-31 23:00:00",), ("1990-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("time"))
    assert hours.where(yearly.within_years("time", 1989, 1989)).count() == 1


def test_differences_use_common_times(spark):
    a = series(spark, [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, NAN)])
    b = series(spark, [("a", 2, 5.0), ("a", 3, 1.0), ("a", 4, 9.0)])
    pairs = align(a, b, ["name", "year"])
    assert pairs.count() == 2
    assert rows(mean_abs_difference(pairs, ["name"])) == [("a", 3.0)]


def test_best_offset_takes_the_first_of_equals(spark):
    data = [("p", di, dj, 0.125 if (di, dj) in ((0, -1), (-1, 1)) else 1.0) for di in (-1, 0, 1) for dj in (-1, 0, 1)]
    data += [("q", 1, 1, None), ("q", -1, 0, 3.0), ("r", 0, 1, None), ("r", 0, 0, None)]
    out = best_offset(spark.createDataFrame(data, "name string, di int, dj int, mad double"), ["name"])
    assert rows(out) == [("p", -1, 1, 0.12), ("q", -1, 0, 3.0), ("r", 0, 0, None)]


def test_shared_cells_tie_exactly(spark):
    around = spark.createDataFrame([("p", -1, 0, 0, 0), ("p", 0, 0, 0, 0), ("p", 1, 0, 0, 1)], "name string, di int, dj int, south_north int, west_east int")
    cell_values = spark.range(1000).selectExpr("0 as south_north", "cast(id % 2 as int) as west_east", "cast(id div 2 as int) as time", "rand(1) as value")
    target = spark.range(500).selectExpr("'p' as name", "cast(id as int) as time", "rand(2) as value")
    out = {(r.di, r.dj): r.mad for r in offset_differences(around, cell_values, target, ["name"]).collect()}
    assert len(out) == 3 and out[-1, 0] == out[0, 0] != out[1, 0]


def test_normals_from_a_state_equal_those_from_days(spark, tmp_path):
    """Any periods, also beyond the data, over years without data and values that are missing."""
    draw = random.Random(6)
    days = [date(y, m, d) for y in (1999, 2000, 2001, 2003, 2004, 2008) for m, d in ((1, 1), (2, 28), (2, 29), (3, 1), (12, 31)) if (m, d) != (2, 29) or y % 4 == 0]
    data = [("v", n, d, draw.choice([NAN, None, draw.uniform(-9, 9)])) for n in "abc" for d in days if draw.random() < 0.8]
    frame = daily(spark, data)
    yearly.write_normals_state(yearly.normals_state(frame, ["name"]), str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    for periods in [((1999, 2003), (2004, 2008)), ((2000, 2000), (2001, 2002)), ((1900, 1999), (2003, 2100)), ((2002, 2002), (2009, 2050)), ((1900, 1950), (2001, 2001))]:
        have = rows(yearly.normals_from_state(state, ["name"], periods), "name", "dayofyear", "normal_1", "normal_2")
        want = rows(yearly.normals_two_periods(frame, ["name"], periods), "name", "dayofyear", "normal_1", "normal_2")
        assert [r[:2] for r in have] == [r[:2] for r in want]
        assert [r[2:] for r in have] == [tuple(x if x is None else pytest.approx(x, abs=1e-9) for x in r[2:]) for r in want]
    text = plan(yearly.normals_from_state(state, ["name"], [(1999, 2003)]))
    assert "PartitionFilters: [year" in text and "(1998,2003)" in text.replace(" ", "")
    empty = yearly.normals_state(frame.limit(0), ["name"])
    assert yearly.normals_from_state(empty, ["name"], [(1999, 2003)]).isEmpty()


def test_no_task_of_a_state_holds_a_whole_year(spark, tmp_path):
    """A year is written to several files, and rows are shuffled before a task groups them."""
    data = [("v", f"n{i}", date(2001, m, 1), float(i)) for i in range(3000) for m in (1, 2)]
    limits = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = [spark.conf.get(name) for name in limits]
    for name in limits:
        spark.conf.set(name, "8k")
    try:
        frame = daily(spark, data).repartition(8)
        yearly.write_normals_state(yearly.normals_state(frame, ["name"]), str(tmp_path / "state"))
    finally:
        for name, value in zip(limits, old, strict=True):
            spark.conf.set(name, value)
    assert len(list((tmp_path / "state" / "year=2001").glob("*.parquet"))) > 1
    state = spark.read.parquet(str(tmp_path / "state"))
    found = yearly.normals_from_state(state, ["name"], [(2001, 2001)])
    assert found.count() == 6000
    text = plan(found)
    assert "Aggregate" not in text[text.rindex("Exchange hashpartitioning") :] and text.count("Exchange hashpartitioning") == 1
