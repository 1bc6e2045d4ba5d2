"""Registered corpus queries against their SQL on the driver's tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from fieldpulse.llm.oracles import ORACLES
from fieldpulse.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables missing")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    got = QUERIES[name](spark, SF_DIR)
    cursor = connection.execute(ORACLES[name])
    columns = sorted(column[0] for column in cursor.description)
    assert sorted(got.columns) == columns
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    expected = sorted(repr([row[i] for i in order]) for row in cursor.fetchall())
    assert expected, "an empty answer proves nothing"
    assert sorted(repr(list(row)) for row in got.select(columns).collect()) == expected
