"""Every registered query against its SQL on the smallest tables."""

import decimal
import glob
import os

import duckdb
import pytest

from tablewright.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def text(value):
    if isinstance(value, (float, decimal.Decimal)) and not isinstance(value, bool):
        return "NaN" if value != value else "%.9g" % (float(value) + 0.0)
    return str(value)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    mine = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE:
        assert mine
        return
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(text(r[i]) for i in order) for r in cursor.fetchall())
    assert mine == theirs
