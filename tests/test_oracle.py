"""Every registered query against its SQL, at the smallest scale by default."""

import os
from glob import glob

import duckdb
import pytest

from __spark_entry__ import entry
from brooklet.plans import batch, lifecycle, oracle, stream, tables

QUERIES = {**batch.QUERIES, **stream.QUERIES, **tables.QUERIES, **lifecycle.QUERIES}
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    found = [tuple(plain(v) for v in row) for row in result.collect()]
    cursor = duck.execute(oracle.SQL[name])
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    order = [names.index(column) for column in result.columns]
    assert sorted(names) == sorted(result.columns)
    expected = [tuple(plain(row[i]) for i in order) for row in cursor.fetchall()]
    spark_kinds = dict(result.dtypes)
    pairs = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}
    pairs |= {"timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}
    assert {c: pairs[k] for c, k in spark_kinds.items()} == kinds
    assert len(found) == len(expected) > 0
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry(spark).count() > 0
