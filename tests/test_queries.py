"""Every registered query against its SQL on the smallest data, and the shape of the registry."""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry
from pricetide.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["sheet_name", "status", "n_rows", "is_total"]
    assert df.count() == 6


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(names)
    assert sorted(got.columns) == columns
    want = collections.Counter(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert collections.Counter(tuple(r[c] for c in columns) for r in got.collect()) == want
