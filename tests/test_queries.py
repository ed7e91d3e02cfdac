from __future__ import annotations

import os

import duckdb
import pytest

from isoframe.plans.oracle import ORACLES
from isoframe.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    mine = QUERIES[name](spark, SF)
    names = sorted(mine.columns)
    theirs = con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in names)} FROM ({ORACLES[name]})").fetchall()
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r) for r in mine.select(*names).collect()), key=key) == sorted(theirs, key=key)
