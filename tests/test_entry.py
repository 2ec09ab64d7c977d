"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as E
from assetlake.queries import load

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_entry(spark):
    out = E.entry(spark)
    assert out.count() > 0 and "score" in out.columns


def test_every_query_has_sql():
    queries, sql = load()
    assert set(queries) == set(sql)


@pytest.mark.parametrize("name", sorted(load()[0]))
def test_query_equals_sql(spark, con, name):
    df = E.queries()[name](spark, DATA)
    got = df.collect()
    res = con.execute(E.oracle_sql()[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(names, res.fetchall())
