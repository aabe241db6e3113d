"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from millrace.plans.catalog import QUERIES
from tools.check import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_each_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    result = tables.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)
