"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from voltarc.plans.oracle import SQL
from voltarc.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else v if isinstance(v, (int, float, str)) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def test_each_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(str([plain(r[c]) for c in columns]) for r in df.collect()) == sorted(str([plain(r[i]) for i in at]) for r in want.fetchall())
