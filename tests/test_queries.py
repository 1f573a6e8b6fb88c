"""Every query with SQL gives DuckDB's rows at sf0.001."""

import os

import duckdb
import pytest

from panelmill.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(SQL[name])
    names = [x[0] for x in found.description]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())
