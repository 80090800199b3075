"""Sources, sink, production runs and the analyses of their product."""

import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daygrid.catalog import CATALOG, DailyVariable
from daygrid.functions.projections import SOURCE_PLANE
from daygrid.grids import Grid, covering_grid, grid_cells, source_grid
from daygrid.operators.daily import daily_wide
from daygrid.operators.regrid import stored_regrid_map
from daygrid.plans.health import completeness, readability
from daygrid.plans.points import TOWNS, annual_point_series, extract_points, extract_points_from_hours, places_frame, point_normals, projected
from daygrid.plans.produce import produce, product_fields, product_wide
from daygrid.plans.verify import cell_series, coordinate_report, source_versus_product
from daygrid.schema import hourly_schema
from daygrid.sources import hourly as src
from daygrid.sources import product
from tests.conftest import plan, rows

SOURCE = source_grid(-152.0, 64.0, 150000.0, 150000.0, 12, 14)
TARGET = covering_grid(SOURCE)


def model(spark, days, hours=(0, 6, 12, 18)):
    """A smooth field on the source grid: temperature falls to the north and rises over time."""
    data = [(datetime(d.year, d.month, d.day, h),) for d in days for h in hours]
    times = spark.createDataFrame(data, "time timestamp_ntz")
    cells = spark.range(SOURCE.cells).selectExpr("cast(id div 12 as int) as south_north", "cast(id % 12 as int) as west_east")
    t = F.dayofyear("time") * 0.1 + F.hour("time") * 0.01 + (F.year("time") - 2000)
    return (
        cells.join(F.broadcast(times), F.lit(True))
        .withColumn("T2", F.lit(280.0) - F.col("south_north") * 2 + F.col("west_east") * 0.3 + t)
        .withColumn("rainnc", F.pmod(F.col("south_north") + F.col("west_east"), F.lit(5)) * 0.1)
        .withColumn("SST", F.lit(float("nan")))
        .withColumn("year", F.year("time"))
    )


DAYS = [date(y, m, d) for y in (2001, 2002, 2003) for m, d in ((1, 1), (1, 2), (1, 3))]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("hourly") / "table")
    model(spark, DAYS).write.partitionBy("year").parquet(root)
    return root


@pytest.fixture(scope="module")
def made(spark, archive, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("product") / "daily")
    hourly = src.read_years(spark, archive, 2001, 2003)
    produce(hourly, ["t2_mean", "rainnc_sum", "sst_mean"], 2001, 2003, SOURCE, TARGET, root, attributes={"source": "test model"})
    return root


def test_year_scan(spark, archive):
    rows_2002 = src.read_years(spark, archive, 2002)
    assert rows_2002.select("year").distinct().collect()[0].year == 2002
    assert "PartitionFilters: [isnotnull(year" in plan(rows_2002)
    with pytest.raises(FileNotFoundError, match="2004"):
        src.read_years(spark, archive, 2003, 2004)
    with pytest.raises(FileNotFoundError, match="no hourly data at"):
        src.read_years(spark, archive + "-nowhere", 2002)


def test_scan_reads_needed_columns_only(spark, archive):
    pruned = src.for_outputs(src.read_years(spark, archive, 2001), ["t2_mean", "t2_max"])
    assert "ReadSchema: struct<south_north:int,west_east:int,time:timestamp_ntz,T2:double>" in plan(pruned) or "rainnc" not in plan(pruned)


def test_declared_schema(spark, archive):
    """Declared source variables that the files lack are missing; the rest reads as without a declaration."""
    declared = src.read_years(spark, archive, 2001, 2003, hourly_schema(["t2_mean", "slp_mean"]))
    assert declared.columns == ["time", "level", "south_north", "west_east", "T2", "slp", "year"]
    assert declared.where("slp is not null or level is not null or T2 is null").isEmpty()
    assert declared.count() == src.read_years(spark, archive, 2001, 2003).count()
    assert len(hourly_schema()) == 43 + 5


def test_append_and_overlap(spark):
    whole = model(spark, DAYS[:3])
    first, rest = whole.where(F.to_date("time") == DAYS[0]), whole.where(F.to_date("time") > DAYS[0]).drop("SST")
    both = src.append_in_time([first, rest])
    assert both.count() == whole.count() and both.columns == whole.columns
    assert src.overlapping_hours(both).isEmpty()
    assert src.overlapping_hours(src.append_in_time([both, first])).count() == first.count()


def test_product_is_a_full_cube(spark, made):
    fields = product.read_product(spark, made)
    assert fields.count() == 3 * 9 * TARGET.cells
    assert fields.groupBy("variable", "year", "time", "y_idx", "x_idx").count().where("count > 1").isEmpty()
    cells = stored_regrid_map(spark, SOURCE, TARGET)
    inside = cells.dropna().count()
    assert fields.where("variable = 't2_mean' and value is not null").count() == 9 * inside
    # A day of missing values sums to 0 inside the domain and has no mean.
    assert fields.where("variable = 'sst_mean' and value is not null").isEmpty()
    assert fields.where("variable = 'rainnc_sum' and value is not null").count() == 9 * inside
    at = fields.where("variable = 't2_mean'").join(cells.dropna().drop("y", "x"), ["y_idx", "x_idx"])
    expected = 280.0 - F.col("south_north") * 2 + F.col("west_east") * 0.3 + F.dayofyear("time") * 0.1 + 0.09 + (F.col("year") - 2000) - 273.15
    assert at.where(F.abs(F.col("value") - expected) > 1e-9).isEmpty()


def test_gap_days_are_missing_everywhere(spark):
    days = [date(2001, 1, 1), date(2001, 1, 4)]
    fields = product_fields(model(spark, days), ["rainnc_sum"], SOURCE, TARGET)
    assert fields.count() == 4 * TARGET.cells
    assert fields.where("day(time) in (2, 3) and value is not null").isEmpty()
    sparse = product_fields(model(spark, days), ["rainnc_sum"], SOURCE, TARGET, fill_missing=False)
    assert rows(sparse, "time", "y_idx", "x_idx", "value") == rows(fields.where("value is not null"), "time", "y_idx", "x_idx", "value")


def test_a_cell_without_rows_stays_in_the_cube(spark):
    days = [date(2001, 1, 1), date(2001, 1, 2)]
    holed = model(spark, days).where("NOT (south_north = 3 AND west_east = 4 AND time >= '2001-01-02')")
    fields = product_fields(holed, ["rainnc_sum"], SOURCE, TARGET)
    assert fields.count() == 2 * TARGET.cells
    fed = stored_regrid_map(spark, SOURCE, TARGET).where("south_north = 3 AND west_east = 4").select("y_idx", "x_idx")
    assert fields.join(fed, ["y_idx", "x_idx"]).where("value IS NULL").count() == fed.count()


def test_a_year_that_lacks_a_column(spark, tmp_path):
    root = str(tmp_path / "hourly")
    model(spark, DAYS[:3]).drop("SST").write.partitionBy("year").parquet(root)
    model(spark, DAYS[3:6]).drop("rainnc", "SST").write.mode("append").partitionBy("year").parquet(root)
    hourly = src.read_years(spark, root, 2001, 2002, hourly_schema(["rainnc_sum", "t2_mean"]))
    with pytest.raises(ValueError, match=r"2002 lacks the source variables \['rainnc'\]"):
        produce(hourly, ["rainnc_sum"], 2001, 2002, SOURCE, TARGET, str(tmp_path / "daily"))
    assert produce(hourly, ["t2_mean"], 2001, 2002, SOURCE, TARGET, str(tmp_path / "daily")).where("value IS NOT NULL").count() > 0


def test_missing_values_still_sum_to_zero(spark):
    empty = model(spark, DAYS[:1]).withColumn("rainnc", F.lit(float("nan")))
    fields = product_fields(empty, ["rainnc_sum"], SOURCE, TARGET)
    assert {r.value for r in fields.select("value").distinct().collect()} == {0.0, None}


def test_hours_are_read_once(spark, archive, tmp_path):
    """The stored daily rows tell the calendar; only the aggregation reads the hours."""
    hourly = src.read_years(spark, archive, 2001, 2003)
    wide = product_wide(hourly, ["t2_mean", "rainnc_sum"], SOURCE, TARGET)
    assert "hourly" not in plan(wide) and plan(wide).count("Exchange hashpartitioning(south_north") <= 1
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = hourly.mapInArrow(count, hourly.schema)
    product_wide(watched, ["t2_mean", "rainnc_sum"], SOURCE, TARGET).count()
    assert seen.value == hourly.count()


def test_levels_in_the_source_check(spark):
    base = model(spark, DAYS[:2])
    high = base.withColumn("level", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("temp", F.col("T2") + 10 * F.col("level"))
    fields = product_fields(high, ["temp_mean"], SOURCE, TARGET)
    lon, lat = SOURCE_PLANE.inverse(F.col("x"), F.col("y"))
    grid = grid_cells(spark, SOURCE).withColumns({"lon": lon, "lat": lat}).withColumnsRenamed({"y_idx": "south_north", "x_idx": "west_east"})
    best = source_versus_product(high, grid, fields, towns(spark), SOURCE, TARGET, variable="temp", product_variable="temp_mean", product_units="K")
    found = {(r.name, r.level): r.exact_mad for r in best.collect()}
    assert len(found) == 18 and set(found.values()) == {0.0}


def test_own_aggregates_are_produced(spark, archive, tmp_path):
    spread = DailyVariable("t2_spread", "T2", "spread", 0.0, "", "", "", "")
    hourly = src.read_years(spark, archive, 2001, 2003)
    kinds = {"spread": lambda c: F.max(c) - F.min(c)}
    made_here = produce(hourly, [spread, "t2_max"], 2001, 2003, SOURCE, TARGET, str(tmp_path / "own"), kinds=kinds)
    values = made_here.where("variable = 't2_spread' AND value IS NOT NULL").agg(F.min("value"), F.max("value")).first()
    assert all(abs(x - 0.18) < 1e-9 for x in values)
    with pytest.raises(FileExistsError, match="t2_spread"):
        produce(hourly, [spread], 2001, 2003, SOURCE, TARGET, str(tmp_path / "own"), kinds=kinds)


def test_levels_in_the_product(spark):
    base = model(spark, DAYS[:2])
    flat = base.withColumn("level", F.lit(None).cast("int")).withColumn("temp", F.lit(None).cast("double"))
    high = base.withColumn("level", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("temp", F.col("T2") + F.col("level")).withColumn("T2", F.lit(None).cast("double"))
    fields = product_fields(flat.unionByName(high), ["t2_mean", "temp_max"], SOURCE, TARGET)
    counts = {(r.variable, r.level): r["count"] for r in fields.groupBy("variable", "level").count().collect()}
    assert counts == {("t2_mean", None): 2 * TARGET.cells, ("temp_max", 1): 2 * TARGET.cells, ("temp_max", 2): 2 * TARGET.cells}


def test_write_guard_and_overwrite_of_one_unit(spark, archive, tmp_path):
    root = str(tmp_path / "daily")
    hourly = src.read_years(spark, archive, 2001, 2002)
    produce(hourly, ["t2_mean", "t2_max"], 2001, 2002, SOURCE, TARGET, root)
    with pytest.raises(FileExistsError, match="t2_mean/2002"):
        produce(hourly, ["rainnc_sum", "t2_mean"], 2002, 2002, SOURCE, TARGET, root)
    assert product.read_product(spark, root, ["rainnc_sum"]).isEmpty()
    warmer = hourly.withColumn("T2", F.col("T2") + 100)
    before = product.read_product(spark, root).agg(F.sum("value")).first()[0]
    unit = product.read_product(spark, root, ["t2_mean"], (2002, 2002)).where("value is not null").count()
    produce(warmer, ["t2_mean"], 2002, 2002, SOURCE, TARGET, root, overwrite=True)
    after = product.read_product(spark, root).agg(F.sum("value")).first()[0]
    assert after - before == pytest.approx(100.0 * unit)
    assert product.read_attributes(spark, root).count() == 4


@pytest.mark.parametrize("open_files", ["0", "32"])
def test_files_are_sorted_by_cell(spark, tmp_path, open_files):
    """However rows reach the writer, each file holds one unit in cell order, so that row groups can be skipped."""
    root = str(tmp_path / "daily")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    try:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", open_files)
        wide = product_wide(model(spark, DAYS), ["t2_mean", "t2_max", "rainnc_sum"], SOURCE, TARGET)
        product.write_wide(wide, ["t2_mean", "t2_max", "rainnc_sum"], TARGET, root)
    finally:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", before)
    assert product.read_product(spark, root).count() == 3 * 9 * TARGET.cells
    import pyarrow.parquet as pq

    files = list((tmp_path / "daily" / "fields").rglob("*.parquet"))
    assert len(files) >= 9
    for f in files:
        part = pq.ParquetFile(f).read(columns=["y_idx", "x_idx", "time"]).to_pylist()
        order = [(sum((r["y_idx"] >> k & 1) << 2 * k + 1 | (r["x_idx"] >> k & 1) << 2 * k for k in range(12)), r["time"]) for r in part]
        assert order == sorted(order)


def test_years_in_several_jobs(spark, archive, made, tmp_path):
    root = str(tmp_path / "daily")
    hourly = src.read_years(spark, archive, 2001, 2003)
    fields = produce(hourly, ["t2_mean", "rainnc_sum"], 2001, 2003, SOURCE, TARGET, root, years_per_job=2)
    order = ["variable", "year", "time", "y_idx", "x_idx", "value"]
    assert rows(fields, *order) == rows(product.read_product(spark, made, ["t2_mean", "rainnc_sum"]), *order)
    assert product.read_attributes(spark, root).count() == 6
    assert product.read_grid(spark, root) == TARGET


def test_unknown_request(spark, archive, tmp_path):
    with pytest.raises(ValueError, match="unknown variable 't3_mean'"):
        produce(src.read_years(spark, archive, 2001), ["t3_mean"], 2001, 2001, SOURCE, TARGET, str(tmp_path / "x"))


def test_source_attributes_are_inherited(spark, tmp_path):
    hourly = model(spark, DAYS[:1]).withMetadata("T2", {"stagger": "M", "description": "TEMP", "units": "K"})
    produce(hourly, ["t2_mean"], 2001, 2001, SOURCE, TARGET, str(tmp_path / "daily"))
    attrs = product.read_attributes(spark, str(tmp_path / "daily")).first().attrs
    assert attrs["stagger"] == "M" and attrs["units"] == "degree_C" and "description" not in attrs


def test_attributes(spark, made):
    table = {(r.variable, r.year): r.attrs for r in product.read_attributes(spark, made).collect()}
    assert len(table) == 9
    attrs = table["t2_mean", 2002]
    assert attrs["units"] == "degree_C" and attrs["cell_methods"] == "time: mean" and attrs["Conventions"] == "CF-1.8"
    assert attrs["source"] == "test model" and attrs["institution"] == "unknown"
    assert table["sst_mean", 2001]["cell_methods"] == "unknown"
    assert Grid.from_attributes(attrs) == TARGET
    merged = product.merge_attributes({"description": "x", "projection": "y", "units": "K", "stagger": "M"}, CATALOG["t2_mean"])
    assert merged["stagger"] == "M" and merged["units"] == "degree_C" and "projection" not in merged and "description" not in merged
    tagged = product.with_attributes(product.read_product(spark, made), merged)
    assert tagged.schema["value"].metadata["long_name"] == "Daily mean temperature at 2 meters"


def test_completeness(spark, made):
    numbers, missing = completeness(spark, made, ["t2_mean", "t2_max"], 2002, 2005)
    assert rows(numbers) == [(8, 2, 6, 25.0)]
    assert rows(missing)[:4] == [("t2_max", 2002), ("t2_max", 2003), ("t2_max", 2004), ("t2_max", 2005)]
    numbers, missing = completeness(spark, made + "-nowhere", ["t2_mean"], 2002, 2003)
    assert rows(numbers) == [(2, 0, 2, 0.0)]
    numbers, missing = completeness(spark, made, ["t2_mean"], 2005, 2002)
    assert rows(numbers) == [(0, 0, 0, None)] and missing.isEmpty()


def test_files_of_a_variable_open(spark, made):
    found = readability(spark, made, ["t2_mean"]).collect()
    assert found and all(r.opened and "variable=t2_mean" in r.path for r in found)


def towns(spark):
    return places_frame(spark, TOWNS)


def test_points_read_only_their_rows(spark, made):
    fields = product.read_product(spark, made, ["t2_mean"], (2002, 2002))
    values = extract_points(fields, projected(towns(spark)), TARGET, tolerance=100000.0)
    text = plan(values)
    assert "BroadcastHashJoin" in text and "In(y_idx" in text and "In(x_idx" in text and "year" in text.split("PartitionFilters")[1][:200]
    assert values.count() == 9 * 3


def test_many_points_give_the_same_values(spark, made, monkeypatch):
    fields = product.read_product(spark, made, ["t2_mean"])
    few = extract_points(fields, projected(towns(spark)), TARGET, tolerance=None)
    monkeypatch.setattr("daygrid.plans.points.FEW_POINTS", 2)
    monkeypatch.setattr("daygrid.plans.points.row_bound", lambda df: None)
    assert "salt" in plan(extract_points(fields, projected(towns(spark)), TARGET, tolerance=None))
    many = extract_points(fields, projected(towns(spark)), TARGET, tolerance=None)
    assert rows(few) == rows(many)


def test_points_from_hours_equal_points_from_the_product(spark, archive, made):
    hourly = src.read_years(spark, archive, 2001, 2003)
    names = ["t2_mean", "rainnc_sum"]
    points = projected(towns(spark))
    direct = extract_points_from_hours(hourly, names, points, SOURCE, TARGET, tolerance=None)
    by_product = extract_points(product.read_product(spark, made, names), points, TARGET, tolerance=None)
    order = ["name", "variable", "time", "value"]
    assert rows(direct, *order) == rows(by_product, *order)
    text = plan(direct)
    assert "In(south_north" in text and text.index("Exchange") < text.index("LeftSemi")


def test_series_and_normals(spark, made):
    fields = product.read_product(spark, made)
    series = annual_point_series(fields, towns(spark), TARGET, ["t2_mean", "rainnc_sum"], tolerance=None)
    assert series.count() == 2 * 9 * 3
    t2 = series.where("variable = 't2_mean'")
    assert t2.where("abs(per_decade - 10) > 1e-6 or abs(fitted - value) > 1e-6").isEmpty()
    assert {r.tag for r in series.select("tag").distinct().collect()} == {"Total Annual", "Mean Annual"}
    with_levels = fields.where("variable = 't2_mean'").withColumn("level", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("value", F.col("value") * F.col("level"))
    apart = annual_point_series(with_levels, towns(spark), TARGET, tolerance=None)
    assert apart.count() == 2 * 9 * 3 and apart.where("abs(per_decade - 10 * level) > 1e-6").isEmpty()
    normals = point_normals(fields, towns(spark), TARGET, ["t2_mean"], ((2001, 2001), (2002, 2003)), tolerance=None)
    assert normals.count() == 9 * 3
    assert normals.where("abs(normal_2 - normal_1 - 1.5) > 1e-9").isEmpty()


def test_source_and_product_agree_at_the_cell(spark, archive, made):
    """At a cell's own coordinates the product is the source, wherever the map sends that product cell to it."""
    hourly = src.read_years(spark, archive, 2001, 2003)
    lon, lat = SOURCE_PLANE.inverse(F.col("x"), F.col("y"))
    grid = grid_cells(spark, SOURCE).withColumns({"lon": lon, "lat": lat}).withColumnsRenamed({"y_idx": "south_north", "x_idx": "west_east"})
    fields = product.read_product(spark, made)
    best = source_versus_product(hourly, grid, fields, towns(spark), SOURCE, TARGET, product_units="degree_C")
    found = {r.name: r for r in best.collect()}
    assert len(found) == 9
    report = coordinate_report(towns(spark), grid)
    # The nearest cell in degrees need not be the nearest in kilometres; the two distances to it agree.
    assert report.where("planar_km > 250 or abs(planar_km - sphere_km) > 3").isEmpty()

    cells = stored_regrid_map(spark, SOURCE, TARGET)
    exact = report.select("name", "south_north", "west_east", F.col("exact_x").alias("x"), F.col("exact_y").alias("y"))
    hits = exact.select(
        "name", "south_north", "west_east", TARGET.y.nearest(F.col("y")).alias("y_idx"), TARGET.x.nearest(F.col("x")).alias("x_idx")
    ).join(cells.drop("x", "y").withColumnsRenamed({"south_north": "row", "west_east": "col"}), ["y_idx", "x_idx"])
    for r in hits.collect():
        same = (r.row, r.col) == (r.south_north, r.west_east)
        assert found[r.name].exact_mad == 0.0
        assert ((found[r.name].exact_di, found[r.name].exact_dj) == (0, 0)) == same


def test_files_per_unit_follow_from_the_grid(spark, tmp_path):
    root = str(tmp_path / "daily")
    names = ["t2_mean", "t2_max"]
    produce(model(spark, DAYS), names, 2001, 2003, SOURCE, TARGET, root)
    files = Counter(f.parent.relative_to(tmp_path) for f in (tmp_path / "daily" / "fields").rglob("*.parquet"))
    assert len(files) == 2 * 3 and set(files.values()) == {product.files_per_unit(2, TARGET)}
    assert product.files_per_unit(2, TARGET) > 4


def test_files_per_unit_with_levels(spark, tmp_path):
    root = str(tmp_path / "daily")
    hourly = model(spark, DAYS[:2]).withColumn("level", F.explode(F.array(F.lit(1), F.lit(5), F.lit(7)))).withColumn("TEMP", F.col("T2"))
    entry = CATALOG["temp_max"]
    hourly = hourly.withColumn(entry.var_id, F.col("T2"))
    produce(hourly, ["temp_max"], 2001, 2001, SOURCE, TARGET, root)
    files = Counter(f.parent for f in (tmp_path / "daily" / "fields").rglob("*.parquet"))
    assert set(files.values()) == {product.files_per_unit(1, TARGET, levels=3)}


def test_a_broken_run_goes_on_where_it_stopped(spark, archive, made, tmp_path, monkeypatch):
    """The second job dies after its rows were written and before they count."""
    root = str(tmp_path / "daily")
    hourly = src.read_years(spark, archive, 2001, 2003)
    names = ["t2_mean", "rainnc_sum"]
    publish, calls = product.publish, []

    def dies(spark, root, commit, attributes=None):
        calls.append(commit)
        if len(calls) == 2:
            raise OSError("lost")
        publish(spark, root, commit, attributes)

    monkeypatch.setattr("daygrid.plans.produce.publish", dies)
    with pytest.raises(OSError, match="lost"):
        produce(hourly, names, 2001, 2003, SOURCE, TARGET, root, years_per_job=1)
    whole = {("t2_mean", 2001), ("rainnc_sum", 2001)}
    assert {(r.variable, r.year) for r in product.committed_units(spark, root).collect()} == whole
    # Rows without an entry in the manifest are there, and nobody reads them.
    assert len(list((tmp_path / "daily" / "fields").glob("commit=*"))) == 2
    assert {(r.variable, r.year) for r in product.read_product(spark, root).select("variable", "year").distinct().collect()} == whole
    numbers, missing = completeness(spark, root, names, 2001, 2003)
    assert numbers.first().missing == 4 and missing.count() == 4

    staged = []
    stage = product.stage_wide
    monkeypatch.setattr("daygrid.plans.produce.publish", publish)
    monkeypatch.setattr("daygrid.plans.produce.stage_wide", lambda wide, group, *rest: (staged.append(([e.name for e in group], rest[3])), stage(wide, group, *rest)))
    first = {r.commit for r in product.all_entries(spark, root).collect()}
    fields = produce(hourly, [*names, "t2_max"], 2001, 2003, SOURCE, TARGET, root, resume=True)
    assert sorted(staged) == [(["t2_max"], [2001]), (["t2_mean", "rainnc_sum", "t2_max"], [2002, 2003])]
    order = ["variable", "year", "time", "y_idx", "x_idx", "value"]
    assert rows(fields.where(F.col("variable").isin(names)), *order) == rows(product.read_product(spark, made, names), *order)
    assert product.read_attributes(spark, root).count() == 9
    entries = product.all_entries(spark, root)
    assert {r.commit for r in entries.where("year = 2001 AND variable <> 't2_max'").collect()} == first
    assert produce(hourly, names, 2001, 2003, SOURCE, TARGET, root, resume=True).count() == fields.where(F.col("variable").isin(names)).count()
    assert len(staged) == 2

    gone = product.remove_stale(spark, root)
    assert gone == [calls[1]] and fields.count() == product.read_product(spark, root).count()


def test_replaced_units_are_not_read_and_go(spark, tmp_path):
    root = str(tmp_path / "daily")
    hourly = model(spark, DAYS)
    produce(hourly, ["t2_mean", "t2_max"], 2001, 2002, SOURCE, TARGET, root)
    total = product.read_product(spark, root).count()
    for _ in range(2):
        produce(hourly, ["t2_mean"], 2001, 2001, SOURCE, TARGET, root, overwrite=True)
    assert product.read_product(spark, root).count() == total
    assert product.read_attributes(spark, root).count() == 4
    assert len(product.remove_stale(spark, root)) == 1  # the first replacement; the first commit still has three units
    assert product.read_product(spark, root).count() == total


def test_scan_filter_for_any_number_of_cells(spark, tmp_path):
    draw = random.Random(3)
    hours = [(datetime(2001, 1, 1, h), r, c, float(r + c)) for h in (0, 1) for r in range(0, 400, 4) for c in range(0, 400, 4)]
    table = spark.createDataFrame(hours, "time timestamp_ntz, south_north int, west_east int, T2 double")
    table.sortWithinPartitions("south_north", "west_east").write.parquet(str(tmp_path / "hours"))
    hourly = spark.read.parquet(str(tmp_path / "hours"))
    wanted = [(draw.randrange(150), draw.randrange(200, 390)) for _ in range(5000)]
    cells = spark.createDataFrame(wanted, "south_north int, west_east int")
    series = cell_series(hourly, cells, "T2")
    pushed = plan(series).split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(south_north" in pushed and "LessThanOrEqual(west_east" in pushed
    have = {(r, c) for _, r, c, _ in hours}
    assert {(r.south_north, r.west_east) for r in series.collect()} == have & set(wanted)


def test_many_points_filter_the_scan(spark, made, monkeypatch):
    fields = product.read_product(spark, made, ["t2_mean"])
    few = extract_points(fields, projected(towns(spark)), TARGET, tolerance=None)
    many = extract_points(fields, projected(towns(spark)), TARGET, tolerance=None, few_points=2)
    pushed = plan(many).split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "y_idx" in pushed and "x_idx" in pushed and rows(few) == rows(many)


def test_dense_days_are_not_shuffled(spark):
    """Only what is missing is generated and joined: nothing on dense data, one day's rows if that day has a gap."""
    wide = product_wide(model(spark, DAYS), ["t2_mean"], SOURCE, TARGET)
    assert "Exchange hashpartitioning" not in plan(wide) and "LeftAnti" not in plan(wide)
    holes = model(spark, DAYS).where("NOT (south_north = 3 AND west_east < 4 AND dayofyear(time) = 2 AND year = 2002)")
    holes = holes.where("NOT (dayofyear(time) = 2 AND year = 2003)")
    partial = product_wide(holes, ["t2_mean"], SOURCE, TARGET)
    text = plan(partial)
    assert "LeftAnti" in text and "2002-01-02" in text.split("LeftAnti")[1]
    order = ["time", "y_idx", "x_idx"]
    assert rows(partial.select(*order)) == rows(wide.select(*order))
    both = wide.select(*order, "t2_mean").alias("a").join(partial.select(*order, F.col("t2_mean").alias("other")).alias("b"), order)
    lost = both.where("t2_mean IS NOT NULL AND other IS NULL").select("time", "y_idx", "x_idx")
    cells = stored_regrid_map(spark, SOURCE, TARGET).where("south_north IS NOT NULL")
    n_hole = cells.where("south_north = 3 AND west_east < 4").count()
    assert Counter(r.time for r in lost.collect()) == {date(2002, 1, 2): n_hole, date(2003, 1, 2): cells.count()} and n_hole
    assert both.where("other IS NOT NULL AND abs(t2_mean - other) > 1e-9").isEmpty()


def test_big_maps_give_the_same_cube(spark):
    names, order = ["t2_mean", "rainnc_sum"], ["time", "y_idx", "x_idx", "t2_mean", "rainnc_sum"]
    holes = model(spark, DAYS[:4]).where("NOT (south_north = 3 AND dayofyear(time) = 2)")
    small = product_wide(holes, names, SOURCE, TARGET)
    big = product_wide(holes, names, SOURCE, TARGET, broadcast_rows=10)
    assert rows(small, *order) == rows(big, *order)


def test_bucketed_source_is_produced_without_a_shuffle(spark):
    """On a table bucketed by cell only the write deals rows anew."""
    model(spark, DAYS[:3]).write.bucketBy(4, "south_north", "west_east").mode("overwrite").saveAsTable("bucketed_model")
    hourly = spark.table("bucketed_model")
    assert "Exchange hashpartitioning" not in plan(daily_wide(hourly, ["t2_mean"]))
    assert "Exchange hashpartitioning" not in plan(product_wide(hourly, ["t2_mean"], SOURCE, TARGET))


def test_only_overlapping_files_are_compared(spark, tmp_path):
    """Files by day and tile: extents alone show that none overlaps; of those that do, the common hours are found."""
    whole = model(spark, DAYS[:3]).drop("SST")
    for i, day in enumerate(DAYS[:3]):
        for side in (0, 1):
            whole.where((F.to_date("time") == F.lit(day)) & (F.col("west_east").between(6 * side, 6 * side + 5))).coalesce(1).write.parquet(str(tmp_path / f"apart/{i}{side}"))
    apart = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "apart"))
    assert src.overlapping_files(apart).isEmpty()
    audit = src.overlapping_hours(apart)
    assert audit.isEmpty() and "FileScan" not in plan(audit)
    again = whole.where((F.to_date("time") == F.lit(DAYS[1])) & (F.col("west_east") > 8) & (F.hour("time") == 6))
    again.coalesce(1).write.parquet(str(tmp_path / "apart/again"))
    both = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "apart"))
    pairs = src.overlapping_files(both).collect()
    assert [sorted(p.split("/")[-2] for p in r) for r in pairs] == [["11", "again"]]
    twice = src.overlapping_hours(both)
    assert twice.count() == again.count() and {r.copies for r in twice.collect()} == {2}
    assert "11/" in plan(twice) and rows(twice) == rows(src.overlapping_hours(both, within_files=True))


def test_absent_rows_of_partial_days_need_no_row_of_the_frame_in_a_shuffle(spark):
    """Each cell's list of days is joined to it; the days it lacks are made after that, at each level."""
    from datetime import date, timedelta

    from daygrid.operators.regrid import _absent

    days = [date(2001, 1, 1) + timedelta(k) for k in range(20)]
    cells = spark.createDataFrame([(a, b) for a in range(3) for b in range(2)], "south_north int, west_east int")
    have = [(days[(3 * a + b + (n or 0) + k) % 20], n, a, b) for a in range(3) for b in range(1) for n in (None, 1) for k in (0, 4, 4)]
    present = spark.createDataFrame([*have, (days[0], 1, 9, 9)], "time date, level int, south_north int, west_east int")
    absent = _absent(present, cells, 6, days, [None, 1])
    found = [(r.time, r.level, r.south_north, r.west_east) for r in absent.collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(d, n, a, b) for d in days for n in (None, 1) for a in range(3) for b in range(2)} - set(have)
    text = plan(absent)
    assert "LeftAnti" not in text and text.index("Generate explode(CASE") < text.index("Join")


def test_a_session_that_says_nothing_gets_one_open_file_per_output(spark, tmp_path):
    from daygrid.grids import Axis

    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    seen = []
    own = product._stage
    try:
        spark.conf.unset(name)
        product._stage = lambda fields, root, commit: seen.append((spark.conf.get(name), plan(fields)))
        grid = Grid(Axis(0.0, 1.0, 3), Axis(0.0, 1.0, 3), "x")
        wide = grid_cells(spark, grid).selectExpr("*", "date'2001-01-01' as time", "cast(null as int) as level", "2001 as year", "1d as t2_mean", "2d as t2_max")
        product.stage_wide(wide, ["t2_mean", "t2_max"], grid, str(tmp_path), "c", [2001], [None])
        assert spark.conf.get(name, None) is None
    finally:
        product._stage = own
        spark.conf.set(name, before)
    # Whole rows are sorted, before they become values.
    assert seen[0][0] == "32" and seen[0][1].index("Expand") < seen[0][1].index("Sort")
