"""The same reductions and look-ups done by pandas and NumPy on random data."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daygrid.catalog import DailyVariable
from daygrid.grids import Axis
from daygrid.operators.daily import complete_days, daily_wide
from daygrid.operators.yearly import normals, trend, with_fit


def entry(kind):
    return DailyVariable(kind, "T2", kind, 0.0, "", "", "", "")


def test_daily_aggregates(spark):
    rng = np.random.default_rng(1)
    times = [datetime(2019, 12, 30) + timedelta(hours=int(h)) for h in range(24 * 9) if not 72 <= h < 120]
    pdf = pd.DataFrame([(t, c, rng.normal()) for t in times for c in range(4)], columns=["time", "west_east", "T2"])
    pdf.loc[rng.random(len(pdf)) < 0.4, "T2"] = np.nan
    pdf.loc[(pdf.west_east == 3) & (pdf.time.dt.day == 30), "T2"] = np.nan
    hourly = spark.createDataFrame(pdf).select(
        F.col("time").cast("timestamp_ntz"), F.lit(0).alias("south_north"), F.col("west_east").cast("int"), "T2"
    )
    got = complete_days(daily_wide(hourly, [entry(k) for k in ("mean", "min", "max")])).toPandas()
    got = got.assign(time=pd.to_datetime(got.time)).set_index(["west_east", "time"]).sort_index()[["mean", "min", "max"]]
    want = pdf.set_index("time").groupby("west_east")["T2"].resample("1D").agg(["mean", "min", "max"])
    assert len(got) == len(want) == 4 * 9
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.sort_index().to_numpy(), rtol=1e-12, equal_nan=True)


def test_circular_mean(spark):
    rng = np.random.default_rng(2)
    angles = rng.uniform(0, 360, (50, 24))
    data = [(datetime(2020, 1, 1, h), 0, c, float(angles[c, h])) for c in range(50) for h in range(24)]
    hourly = spark.createDataFrame(data, "time timestamp_ntz, south_north int, west_east int, T2 double")
    got = {r.west_east: r.circular_mean for r in daily_wide(hourly, [entry("circular_mean")]).collect()}
    want = np.angle(np.exp(1j * np.radians(angles)).mean(axis=1), deg=True) % 360
    np.testing.assert_allclose([got[c] for c in range(50)], want, atol=1e-9)


def test_trend_line(spark):
    rng = np.random.default_rng(3)
    years = np.arange(1960, 2021)
    data = {n: 0.03 * (years - 1990) * n + rng.normal(size=len(years)) for n in range(5)}
    for n in data:
        data[n][rng.random(len(years)) < 0.2] = np.nan
    series = spark.createDataFrame([(n, int(y), float(v)) for n, vs in data.items() for y, v in zip(years, vs)], "name int, year int, value double")
    lines = {r.name: r for r in trend(series, ["name"]).collect()}
    fitted = with_fit(series, ["name"]).toPandas().sort_values(["name", "year"])
    for n, values in data.items():
        present = ~np.isnan(values)
        slope, intercept = np.polyfit(years[present], values[present], 1)
        assert (lines[n].slope, lines[n].per_decade) == pytest.approx((slope, 10 * slope), rel=1e-7)
        assert lines[n].mean == pytest.approx(np.nanmean(values))
        np.testing.assert_allclose(fitted[fitted.name == n].fitted, np.polyval([slope, intercept], years), atol=1e-7)


def test_day_of_year_normals(spark):
    days = pd.date_range("1990-01-01", "1994-12-31")
    pdf = pd.DataFrame({"time": days, "value": np.sin(np.arange(len(days)))})
    daily = spark.createDataFrame(pdf).select(F.lit("a").alias("name"), F.to_date("time").alias("time"), "value")
    got = normals(daily, ["name"], (1991, 1993)).toPandas().set_index("dayofyear").sort_index().normal
    inside = pdf[pdf.time.dt.year.between(1991, 1993)]
    want = inside.groupby(inside.time.dt.dayofyear).value.mean()
    np.testing.assert_allclose(got, want, rtol=1e-12)


@settings(max_examples=15, deadline=None)
@given(
    step=st.sampled_from([4.0, -4.0, 10.0, -0.5]),
    n=st.integers(1, 12),
    places=st.lists(st.integers(-80, 240).map(lambda k: k * 0.5), min_size=1, max_size=40),
)
def test_nearest_on_an_axis(spark, step, n, places):
    """Half steps hit the ties; pandas is the reference for both directions of an axis."""
    axis = Axis(10.0, step, n)
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(places)], "id int, p double")
    got = {r.id: r.i for r in frame.select("id", axis.nearest(F.col("p")).alias("i")).collect()}
    index = pd.Index([10.0 + i * step for i in range(n)])
    want = index.get_indexer(places, method="nearest")
    assert [got[i] for i in range(len(places))] == list(want)
