"""Operators that SQL can express: the query equals its DuckDB SQL."""

import duckdb
import pytest

from kassa.llm.queries import QUERIES, oracle_sql

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF001}/{table}.parquet'")
    want = con.sql(oracle_sql()[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF001)
    assert sorted(got.columns) == columns
    rows = sorted(map(repr, map(tuple, got.select(columns).collect())))
    assert rows == sorted(map(repr, want.project(", ".join(columns)).fetchall()))
    assert rows
