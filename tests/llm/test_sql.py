"""Queries that SQL can express against that SQL."""

import duckdb
import pytest
from edge_cases import SF_DIR, tally

from brooklet.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(names)
    assert tally(found.select(*names)) == sorted(cursor.fetchall(), key=repr)
