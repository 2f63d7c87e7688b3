"""Every registered query of the training-data operators against its SQL on another engine."""

import re

import pytest

import __spark_entry__ as contract
from cartspark.llm.oracle import ORACLE_SQL
from cartspark.llm.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    found = contract.queries()
    assert sorted(int(re.match(r"op(\d+)_", name).group(1)) for name in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() <= found.keys() and "pipeline" in found
    assert ORACLE_SQL.items() <= contract.oracle_sql().items() and ORACLE_SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    result = engine.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(columns) == sorted(df.columns)
    want = sorted(map(tuple, result.fetchall()), key=str)
    assert want and sorted(map(tuple, df.select(*columns).collect()), key=str) == want
