"""The text operators' queries with SQL agree with DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from quillon.llm import queries
from tests.test_entry import DATA, TABLES, plain

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are absent")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, db, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
