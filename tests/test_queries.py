"""Every registered query against its SQL counterpart on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from gidlake.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value.isoformat() if hasattr(value, "isoformat") else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert not [t for _, t in frame.dtypes if t.startswith(("array", "struct", "map"))]
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert table(frame.columns, frame.collect()) == table(columns, result.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
