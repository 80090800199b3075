import pytest

from daygrid.catalog import (
    CATALOG, KELVIN_SHIFT, catalog_frame, is_levelled, lookup, request_report, source_variables, unknown_names, with_catalog,
)
from pyspark.sql import functions as F

from tests.conftest import rows


def test_size_and_kinds():
    assert len(CATALOG) == 68
    kinds = [e.agg_kind for e in CATALOG.values()]
    assert {k: kinds.count(k) for k in sorted(set(kinds))} == {"circular_mean": 1, "max": 19, "mean": 25, "min": 9, "sum": 14}
    assert len(source_variables(CATALOG)) == 43


def test_dimensions(spark):
    dims = [e.dims for e in CATALOG.values()]
    assert (dims.count(3), dims.count(2)) == (25, 43)
    table = catalog_frame(spark)
    assert table.where(is_levelled(F.col("var_id")) != (F.col("dims") == 3)).count() == 0


def test_only_two_families_are_shifted():
    shifted = {e.var_id for e in CATALOG.values() if e.offset}
    assert shifted == {"T2", "ctt"}
    assert {e.offset for e in CATALOG.values()} == {0.0, KELVIN_SHIFT}


def test_names_say_how_they_are_made():
    for e in CATALOG.values():
        kind = "mean" if e.agg_kind == "circular_mean" else e.agg_kind
        assert e.name.endswith(f"_{kind}")
        assert e.units != "K" or e.offset == 0.0


def test_unknown_name_lists_ten_known_ones():
    with pytest.raises(ValueError) as e:
        lookup("t2")
    assert str(e.value).count(",") == 10 and "'t2'" in str(e.value)


def test_source_variables_ignore_unknown_names():
    assert source_variables(["t2_mean", "nothing", "t2_max", "rh2_min"]) == ["T2", "rh2"]


def test_requests(spark):
    names = ["t2_mean", "T2", "RH2_MEANS", "zzz", "", None]
    asked = spark.createDataFrame([(n,) for n in names + names], "name string")
    report = {r.name: (r.is_valid, r.message) for r in request_report(asked, "name").collect()}
    assert report["t2_mean"] == (True, "'t2_mean' is in the catalogue")
    assert report["T2"][1].endswith("similar names: t2_mean, t2_min, t2_max")
    assert report["RH2_MEANS"][1].endswith("similar names: rh2_mean")
    assert report["zzz"] == (False, "'zzz' is unknown")
    assert report[""] == report[None] == (False, "empty request")
    assert unknown_names(asked, "name").distinct().count() == 5


def test_lookup_join(spark):
    asked = spark.createDataFrame([("t2_mean",), ("zzz",)], "name string")
    assert rows(with_catalog(asked, "name", "left").select("name", "var_id")) == [("t2_mean", "T2"), ("zzz", None)]


# Some of the catalogue's rows as they must read.
EXPECTED = {
    "t2_mean": ("T2", "mean", KELVIN_SHIFT, "degree_C", 2),
    "rainnc_sum": ("rainnc", "sum", 0.0, "mm", 2),
    "wdir10_mean": ("wdir10", "circular_mean", 0.0, "degree", 2),
    "twb_max": ("twb", "max", 0.0, "K", 3),
    "smois_mean": ("SMOIS", "mean", 0.0, "m3 m-3", 3),
    "height_mean": ("height", "mean", 0.0, "m", 3),
}


def test_rows_read_as_expected():
    found = {n: (e.var_id, e.agg_kind, e.offset, e.units, e.dims) for n, e in CATALOG.items() if n in EXPECTED}
    assert found == EXPECTED
