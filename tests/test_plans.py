"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the checks)
from checks import views
from checks.base import QUERIES
from daygrid.operators.daily import daily_wide
from daygrid.operators.regrid import regrid, stored_regrid_map
from daygrid.operators.yearly import within_years
from tests.conftest import plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython|FlatMapGroups|AggregateInPandas", text)
    assert "FileScan" in text or "Scan parquet" in text


def test_one_shuffle_for_all_outputs_on_the_same_rows(spark, sf_dir):
    text = plan(QUERIES["a7_fused_outputs"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan parquet") == 1
    text = plan(QUERIES["e_full_catalogue"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("FileScan parquet") == 2


def test_levels_are_skipped_by_the_scan(spark, tmp_path):
    views.hourly_all(spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "h"))
    hourly = spark.read.parquet(str(tmp_path / "h"))
    flat, high = plan(daily_wide(hourly, ["t2_mean"])), plan(daily_wide(hourly, ["temp_mean"]))
    assert "PushedFilters: [IsNull(level)]" in flat and "temp" not in flat
    assert "PushedFilters: [IsNotNull(level)]" in high and "T2" not in high


def test_period_reaches_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(within_years("l_shipdate", 1996, 1997)).select("l_quantity")
    text = plan(lines)
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in text and "LessThan(l_shipdate,1998-01-01" in text
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_bucketed_source_needs_no_shuffle(spark, sf_dir):
    """Source tables bucketed by cell are reduced and reprojected where they lie."""
    hourly = views.years_hourly(spark, sf_dir)
    hourly.write.bucketBy(8, "south_north", "west_east").mode("overwrite").saveAsTable("bucketed_hourly")
    rows = views.grid_rows(spark, sf_dir)
    target = views.target_grid(rows)
    cells = stored_regrid_map(spark, views.model_grid(rows), target)
    out = regrid(daily_wide(spark.table("bucketed_hourly"), ["t2_mean"]), cells, target.cells)
    text = plan(out)
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    plain = regrid(daily_wide(hourly, ["t2_mean"]), cells, target.cells)
    assert out.agg(F.sum("t2_mean"), F.count("*")).first()[1] == plain.count()


def test_big_map_is_not_broadcast(spark, sf_dir):
    rows = views.grid_rows(spark, sf_dir)
    target = views.target_grid(rows)
    cells = stored_regrid_map(spark, views.model_grid(rows), target)
    daily = daily_wide(views.years_hourly(spark, sf_dir), ["t2_mean"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(regrid(daily, cells, target.cells, broadcast_rows=10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text and "salt" in text
