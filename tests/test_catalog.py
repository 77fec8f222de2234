"""Every query against its SQL in DuckDB, on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

from tessera.plans.catalog import ORACLES, QUERIES

EMPTY = {"j10_check_folds"}  # expected to find nothing


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return tuple(map(plain, v)) if isinstance(v, list) else v


def order(row):
    return tuple((x is None, type(x).__name__ if not isinstance(x, (int, float)) else "n", x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, sf, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=order)
    cur = db.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=order)
    assert got == want
    assert got or name in EMPTY


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
