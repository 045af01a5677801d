"""Every query against its SQL on DuckDB, over whole tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lodestrata.plans.job_queries import QUERIES
from tools.compare import canonical

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    ours = [tuple(row) for row in df.collect()]
    text = oracle_sql().get(name)
    if text is None:
        assert ours
        return
    result = duck.execute(text)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, ours) == canonical(names, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
