"""Queries that have SQL, against it, on whole small tables."""

import duckdb
import pytest

from roadlark.llm.queries import QUERIES, SQL

TABLES = ("conversations", "documents", "embeddings", "pages")


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    result = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in result.select(columns).collect()) == want
