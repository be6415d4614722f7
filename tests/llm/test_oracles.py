"""The queries that SQL can express, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from corpusloom.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DIR}/documents.parquet')")
    result = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(result.fetchall())
