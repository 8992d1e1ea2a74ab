"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from frameline.fixtures import Tables
from frameline.registry import load
from tools.check import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
CATALOG = load()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, engine, name):
    q = CATALOG[name]
    ours = q.run(Tables(spark, FOLDER)).toPandas()
    assert len(ours.columns) > 0
    if q.sql is not None:
        theirs = engine.execute(q.sql).fetchdf()
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert canonical(ours) == canonical(theirs)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["job_id", "objects", "bytes"]
