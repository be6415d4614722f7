"""Every registered query against its DuckDB counterpart on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from corpusloom.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, list) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DIR)
    rows = df.collect()
    if name not in ORACLE_SQL:
        assert df.columns
        return
    result = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    wanted = sorted("|".join(plain(r[columns.index(c)]) for c in sorted(columns)) for r in result.fetchall())
    assert sorted("|".join(plain(r[c]) for c in sorted(columns)) for r in rows) == wanted
