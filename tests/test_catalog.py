"""Every registered query of the environmental engine against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from landscore.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert got == sorted(map(repr, want))
