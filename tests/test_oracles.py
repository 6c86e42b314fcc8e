"""Every query against its SQL, at a small scale, and without plan shapes that do not scale."""

import re

import pytest
from compare import duckdb_tables, spark_rows, sql_rows

import __spark_entry__ as spark_entry
from escrutinio.plans import oracles, queries

SF_DIR = "/root/testdata/sf0.01"  # ties that a smaller scale lacks
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= spark_entry.queries().keys()
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", plan)
    got, expected = spark_rows(df), sql_rows(connection, ORACLES[name])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]


def test_entry_is_lazy_and_not_empty(spark):
    assert spark_entry.entry(spark).count() == 201
