"""Every registered query against its SQL counterpart on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__
from checks.base import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _text(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(_text(x) for x in r) for r in df.select(columns).collect())

    cursor = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == described
    order = [names.index(c) for c in columns]
    want = sorted(tuple(_text(r[i]) for i in order) for r in cursor.fetchall())
    assert got == want
    assert got, "a check on no rows checks nothing"


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    out = __spark_entry__.entry(spark)
    assert out.columns == ["day", "south_north", "west_east", "variable", "value"]
    assert out.count() > 0
