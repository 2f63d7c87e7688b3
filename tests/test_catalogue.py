"""Every query against its SQL on another engine."""

import pytest

import __spark_entry__ as contract
from cartspark.plans.catalogue import QUERIES
from cartspark.plans.oracle import ORACLE_SQL

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"


def comparable(rows, order):
    cells = ((row[i] for i in order) for row in rows)
    return sorted(tuple(f"{c:.9g}" if isinstance(c, float) else str(c) for c in row) for row in cells)


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{FOLDER}/events.parquet')")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE_SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    result = engine.execute(ORACLE_SQL[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = [df.columns.index(column) for column in columns]
    expected = comparable(result.fetchall(), range(len(columns)))
    assert expected
    assert comparable([tuple(row) for row in df.collect()], order) == expected


def test_entry(spark):
    assert [row["itemid"] for row in contract.entry(spark).collect()][:3] == [26, 63, 67]
