"""Every registered query against its SQL on the driver's tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables missing")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(contract._REGISTERED))
def test_query_equals_its_oracle(spark, oracle, name):
    got = contract.queries()[name](spark, SF_DIR)
    cursor = oracle.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    expected = cursor.fetchall()
    assert expected, "an empty answer proves nothing"
    assert _rows(got.columns, got.collect()) == _rows(columns, expected)


def test_every_query_has_an_oracle():
    assert set(contract._REGISTERED) <= set(contract.queries()) & set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
