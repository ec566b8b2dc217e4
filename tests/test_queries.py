"""Registered graph queries against their oracles at the smoke scale."""

from pathlib import Path

import duckdb
import pytest

from graphloom.plans.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are needed")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(DATA))
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
