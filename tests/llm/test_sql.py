"""Queries that SQL can express, against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from callweave.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_its_sql(spark, name):
    made = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        made.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    got = queries.QUERIES[name](spark, SF)
    cursor = made.execute(queries.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))
