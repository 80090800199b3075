"""The queries of this subpackage that SQL can express, against their SQL on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__
from daygrid.llm.queries import ORACLES, QUERIES

SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        duck.execute(f"create view {file.split('.')[0]} as select * from '{sf_dir}/{file}'")
    frame = QUERIES[name](spark, sf_dir)
    found = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in found.description}
    assert {c: SPARK_TYPES[t] for c, t in frame.dtypes} == described
    want = sorted(map(str, found.fetchall()))
    assert sorted(str(tuple(r)) for r in frame.select(*described).collect()) == want and want


def test_all_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
