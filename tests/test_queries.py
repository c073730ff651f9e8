"""Every registered query against its SQL twin in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents labels conversations pages events lineitem".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def own(names):
    """The queries of this library without those of its separate subpackage."""
    return sorted(set(names) - set(contract.LLM_QUERIES))


def test_every_query_has_sql():
    assert own(contract.queries()) == own(contract.oracle_sql())


@pytest.mark.parametrize("name", own(contract.queries()))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(result.columns)
    assert rows(result.columns, result.collect()) == rows(names, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
