"""Each query that has SQL against it, over whole tables."""

import os

import pytest

from compare import duck, duck_rows, spark_rows
from ledgerlens.llm.oracle import oracle_sql
from ledgerlens.llm.queries import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    columns, rows = spark_rows(queries()[name](spark, FOLDER))
    expected_columns, expected = duck_rows(duck(FOLDER), oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
