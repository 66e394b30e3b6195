"""Queries of the text operators that SQL can express, against their SQL on small tables."""

import duckdb
import pytest

from tierflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_vector_codes", "op13_url_filter"])
def test_query_equals_sql(spark, duck, name):
    wanted = duck.execute(ORACLES[name])
    cols = [c[0] for c in wanted.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(cols)
    assert sorted(map(repr, map(tuple, found.select(*cols).collect()))) == sorted(map(repr, wanted.fetchall()))
