"""Each registered query against its SQL, both over whole tables."""

import os

import pytest

import __spark_entry__ as registry
import oracle_queries
from compare import duck, duck_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = registry.audit_queries(), oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module", autouse=True)
def shared_audit(spark):
    """One audit for all queries, as a session that runs many reports would have."""
    build, shared = registry.audit, registry.audit(spark, FOLDER)
    registry.audit = lambda s, folder: shared if folder == FOLDER else build(s, folder)
    yield
    registry.audit = build


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected = duck_rows(connection, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark):
    assert registry.entry(spark).count() > 0
