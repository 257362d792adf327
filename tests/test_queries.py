"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from episodica.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "tolist"):
        return plain(v.tolist())
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def table_of(rows, cols, order):
    at = [cols.index(c) for c in order]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    rel = con.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = table_of(df.collect(), df.columns, sorted(df.columns)), table_of(rel.fetchall(), rel.columns, sorted(df.columns))
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_has_both(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
