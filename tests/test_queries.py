"""Every query with SQL gives the SQL's rows (the registry of the library; the subpackage llm has tests of its own)."""

import os

import duckdb
import pytest

from changelens import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_against_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    sql = db.sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(sql.columns)
    columns = sorted(df.columns)
    mine = sorted(str([r[c] for c in columns]) for r in df.collect())
    at = [sql.columns.index(c) for c in columns]
    assert mine == sorted(str([r[k] for k in at]) for r in sql.fetchall())
