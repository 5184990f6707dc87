"""Every query with SQL agrees with DuckDB on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quillon import plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are absent")


def plain(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v + 0.0:.7g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_agrees_with_sql(spark, db, name):
    df = plans.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = db.execute(plans.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
