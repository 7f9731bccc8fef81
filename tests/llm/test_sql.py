"""Queries against their SQL, value for value, over whole tables."""

import duckdb
import pytest

from shortfall.llm.queries import QUERIES
from shortfall.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cur = con.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    want = sorted(cur.fetchall(), key=repr)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == want
