"""Logs, file headers, variable sets and work lists."""

import pytest
from pyspark.sql import functions as F

from daygrid.functions.units import to_celsius
from daygrid.operators import audit
from daygrid.plans.health import readability, schema_consistency, timed_out_units
from daygrid.sources.logs import read_logs, units_of
from tests.conftest import rows


@pytest.fixture(scope="module")
def log_folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("logs")
    (root / "t2_mean").mkdir()
    (root / "t2_mean" / "era5_t2_mean_1999.out").write_text("started\nslurmstepd: error: JOB 1 CANCELLED AT 2020 DUE TO TIME LIMIT\n")
    (root / "era5_rainnc_sum_2000.out").write_text("JOB 2 CANCELLED AT noon\nfor no reason\n")
    (root / "era5_wspd10_max_2001.out").write_text("CANCELLED AT 1\n" + "work\n" * 5000 + "it was DUE TO TIME LIMIT\n")
    (root / "era5_broken.out").write_text("CANCELLED AT 1 DUE TO TIME LIMIT\n")
    (root / "era5_empty_2002.out").write_text("")
    (root / "notes.txt").write_text("CANCELLED AT 1 DUE TO TIME LIMIT\n")
    return str(root)


def test_timed_out_units(spark, log_folder):
    assert rows(timed_out_units(spark, log_folder)) == [("t2_mean", 1999), ("wspd10_max", 2001)]
    asked = audit.work_list(audit.variables_frame(spark, ["t2_mean", "rainnc_sum"]), 1990, 2010)
    assert rows(timed_out_units(spark, log_folder, asked)) == [("t2_mean", 1999)]


def test_unparsable_log_names_are_skipped(spark, log_folder):
    units = units_of(read_logs(spark, log_folder)).select("variable", "year").distinct()
    assert rows(units) == [("rainnc_sum", 2000), ("t2_mean", 1999), ("wspd10_max", 2001)]


def test_files_that_do_not_open(spark, tmp_path):
    for name, columns in (("a", ["T2", "time"]), ("b", ["time", "T2"]), ("c", ["T2", "rh2", "time"])):
        spark.range(3).select(*[F.col("id").alias(c) for c in columns]).coalesce(1).write.parquet(str(tmp_path / name))
    good = next((tmp_path / "a").glob("*.parquet")).read_bytes()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "cut.parquet").write_bytes(good[: len(good) // 2])
    found = {r.path.rsplit("/", 2)[-2]: (r.opened, r.rows) for r in readability(spark, str(tmp_path)).collect()}
    assert found == {"a": (True, 3), "b": (True, 3), "c": (True, 3), "d": (False, None)}
    summary, groups = schema_consistency(spark, str(tmp_path), ["time"])
    assert rows(summary, "files", "variable_sets", "consistent", "files_failed") == [(3, 2, False, 1)]
    assert [(r.variables, r.files, r.is_baseline) for r in groups.orderBy("files").collect()] == [(["T2", "rh2"], 1, False), (["T2"], 2, True)]


def test_unusual_paths(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "variable=a%3Ab c+d" / "x"))
    assert [(r.opened, r.rows) for r in readability(spark, str(tmp_path)).collect()] == [(True, 3)]
    summary, _ = schema_consistency(spark, str(tmp_path))
    assert rows(summary, "files", "files_failed") == [(1, 0)]


def file_vars(spark, sets):
    return spark.createDataFrame([(p, v) for p, vs in sets.items() for v in vs], "path string, variable string")


def test_variable_sets(spark):
    files = file_vars(spark, {"f1": "ba", "f2": "abab", "f3": "a", "f4": "ab", "f0": "ab"})
    sets = audit.variable_sets(files)
    groups = {tuple(r.variables): (r.files, r.example, r.is_baseline) for r in audit.set_groups(sets).collect()}
    assert groups == {("a", "b"): (4, "f0", True), ("a",): (1, "f3", False)}
    assert rows(audit.deviating_files(sets).select("path")) == [("f3",)]
    assert rows(audit.consistency(sets)) == [(5, 2, False)]
    assert rows(audit.consistency(sets.where("path = 'f3'"))) == [(1, 1, True)]
    assert rows(audit.consistency(sets.where("false"))) == [(0, 0, False)]


def test_a_file_with_most_rows(spark):
    """One file holds nearly all rows: it still reaches its group as its few names."""
    hot = spark.range(50000).select(F.lit("hot").alias("path"), F.concat(F.lit("v"), F.col("id") % 3).alias("variable"))
    sets = audit.variable_sets(hot.unionByName(file_vars(spark, {"cold": ["v0", "v1", "v2"]})))
    assert rows(audit.consistency(sets)) == [(2, 1, True)]


def test_work_list_and_units(spark):
    expected = audit.work_list(audit.variables_frame(spark, ["a", "b", "a"]), 2000, 2002)
    assert expected.count() == 6
    existing = spark.createDataFrame([("a", 2000), ("a", 2000), ("c", 2001)], "variable string, year int")
    assert rows(audit.present_units(expected, existing)) == [("a", 2000)]
    assert audit.missing_units(expected, existing).count() == 5
    assert rows(audit.completion(expected, existing, ["variable"])) == [("a", 3, 1, 2, pytest.approx(100 / 3)), ("b", 3, 0, 3, 0.0)]


@pytest.mark.parametrize("default, unknown", [("kelvin", -273.15), ("unchanged", 0.0)])
def test_units(spark, default, unknown):
    shifts = {"K": -273.15, "kelvin": -273.15, "degC": 0.0, "Celsius": 0.0, "C": 0.0, "degrees_celsius": 0.0, "degree_C": 0.0, None: unknown, "F": unknown}
    df = spark.createDataFrame([(u,) for u in shifts], "unit string")
    out = {r.unit: r.v for r in df.select("unit", to_celsius(F.lit(0.0), F.col("unit"), default).alias("v")).collect()}
    assert out == shifts
    with pytest.raises(ValueError):
        to_celsius(F.lit(0.0), F.lit("K"), "fahrenheit")


def test_sets_are_not_collected_into_one_row(spark):
    sets = spark.createDataFrame([("f1", ["a"]), ("f2", ["a", "b"])], "path string, variables array<string>")
    for frame in (audit.set_groups(sets), audit.consistency(sets)):
        assert "collect_list" not in frame._jdf.queryExecution().optimizedPlan().toString()
