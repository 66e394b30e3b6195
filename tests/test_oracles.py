"""Each registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from tierflow.plans.oracles import ORACLES
from tierflow.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


# Pairs of all rows, and rows sent through Python.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def comparable(row):
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else repr(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.execute(ORACLES[name])
    cols = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(cols)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in UNWANTED if op in plan]
    left = sorted(comparable(r) for r in found.select(*cols).collect())
    assert left == sorted(comparable(r) for r in wanted.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= driver.queries().keys() and ORACLES.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    assert not driver.entry(spark).isEmpty()
