"""Every registered query against the same question in SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from meshfold.plans import oracle
from meshfold.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(oracle.SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(oracle.SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, sql, name):
    found = entry.queries()[name](spark, FOLDER)
    asked = sql.execute(entry.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in asked.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    columns, order = sorted(types), [list(types).index(c) for c in sorted(types)]
    got = sorted(repr(tuple(r[c] for c in columns)) for r in found.collect())
    expected = sorted(repr(tuple(r[i] for i in order)) for r in asked.fetchall())
    assert got == expected


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["window_id", "n"] and found.count() > 0
