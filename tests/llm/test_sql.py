"""The queries that SQL can express, against it."""

import os

import pytest

from tests.test_queries import SF, plain
from voltarc.llm.queries import QUERIES, SQL


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for f in os.listdir(SF):
        duck.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df, want = QUERIES[name](spark, SF), duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(str([plain(r[c]) for c in columns]) for r in df.collect()) == sorted(str([plain(r[i]) for i in at]) for r in want.fetchall())
