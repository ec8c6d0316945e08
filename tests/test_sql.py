"""Every query with SQL against that SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple("NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=str)


def test_registry():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry_points.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
