"""Every registered query against its SQL, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x.isoformat() if isinstance(x, datetime.date) else x


def table(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert table(got.collect(), got.columns) == table(want.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())
