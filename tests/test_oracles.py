"""Every registered query against its SQL oracle, on the smallest data set."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        assert ours
        return
    relation = duck.sql(oracle)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert ours == theirs


def test_entry_returns_the_flagship_panel(spark):
    df = contract.entry(spark)
    assert {"customer_id", "year", "treatment"} <= set(df.columns)
