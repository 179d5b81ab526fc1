"""Every registered query against its SQL on the smallest tables, and the shape of plans."""

import glob
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from checks import building_blocks, call_chain

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from compare import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
SF_CALLS = "/root/testdata/sf0.01"  # enough calls of known offices
QUERIES = building_blocks.QUERIES | call_chain.QUERIES
SQL = building_blocks.SQL | call_chain.SQL
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


def connect(folder):
    made = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        made.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return made


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.fixture(scope="module")
def calls_connection():
    return connect(SF_CALLS)


@pytest.mark.parametrize("name", building_blocks.QUERIES)
def test_operator_equals_its_sql(spark, connection, name):
    ok, text = compare(spark, SF, name, QUERIES[name], SQL.get(name), connection)
    assert ok, text


@pytest.mark.parametrize("name", call_chain.QUERIES)
def test_call_stage_equals_its_sql(spark, calls_connection, name):
    ok, text = compare(spark, SF_CALLS, name, QUERIES[name], SQL[name], calls_connection)
    assert ok and "rows=0/" not in text, text


def test_compare_sees_a_wrong_value_and_a_wrong_name(spark, connection):
    query = QUERIES["repeat_five_times"]
    sql = SQL["repeat_five_times"]
    assert not compare(spark, SF, "x", lambda s, d: query(s, d).limit(3), sql, connection)[0]
    assert not compare(spark, SF, "x", lambda s, d: query(s, d).withColumnRenamed("c_name", "n"), sql, connection)[0]
    wrong = sql.replace("c_custkey,", "c_custkey + 1 AS c_custkey,")
    assert not compare(spark, SF, "x", query, wrong, connection)[0]


@pytest.mark.parametrize("name", [
    "tolerance_pairs", "tolerance_left", "calls_by_outcome", "stats_export", "dataset_diff_by_column",
    "group_total_hot_keys", "org_directory_labels", "dial_codes_of_number",
])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in FORBIDDEN if bad in plan]


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)


def test_the_match_is_computed_once(spark):
    """The flagship reads stored matches and legs: no tolerance join is left in its plan."""
    plan = QUERIES["calls_by_outcome"](spark, SF_CALLS)._jdf.queryExecution().optimizedPlan().toString()
    assert "_left_bucket" not in plan and plan.count("Join") <= 3


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["day", "Origine", "Aboutissement_SVI", "n_legs", "received", "emitted"]
    assert got.count() > 0
