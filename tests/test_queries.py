"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


OWN = [name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)]  # those have tests of their own


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert rows
        return
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, rows) == table(columns, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) <= set(entry.queries())
