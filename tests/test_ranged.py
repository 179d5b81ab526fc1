"""Stored key ranges: comparison equals that of all rows and reads only ranges that differ."""

import random
import re

import pytest
from pyspark.sql import functions as F

from callweave.operators import changed_rows
from callweave.operators.compare import ColumnTypeError
from callweave.operators.ranged import (
    RangeEdgesError, changed_rows_ranged, differing_ranges, range_edges, range_of, store_ranged, stored_rows,
)
from conftest import rows


def stored(spark, folder, left, right, key="k", ranges=60):
    store_ranged(left, f"{folder}/l", key, ranges)
    store_ranged(right, f"{folder}/r", key, like=f"{folder}/l")
    return f"{folder}/l", f"{folder}/r"


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("é x").alias("odd name"))


def test_only_changed_ranges_are_read(spark, tmp_path, numbers):
    right = numbers.withColumn("v", F.when(F.col("k").between(2510, 2520), F.lit(9)).otherwise(F.col("v"))).where("k <> 4999")
    paths = stored(spark, tmp_path, numbers, right)
    ranges = differing_ranges(spark, *paths)
    assert 2 <= len(ranges) <= 4
    found = changed_rows_ranged(spark, *paths)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(changed_rows(numbers, right)) and found.count() == 23
    picked = re.findall(r"PartitionFilters: \[_range#\d+ IN \(([\d,]+)\)\]", plan)
    assert picked == [",".join(map(str, ranges))] * 2


def test_equal_sets_read_no_rows(spark, tmp_path, numbers):
    paths = stored(spark, tmp_path, numbers, numbers.repartition(7).select("odd name", "v", "k"))
    assert differing_ranges(spark, *paths) == [] and changed_rows_ranged(spark, *paths).collect() == []


def test_random_sets_with_nulls_copies_and_a_hot_key(spark, tmp_path):
    rng = random.Random(4)
    for turn in range(3):
        some = [(rng.choice([None, 5, 5, 5, rng.randint(0, 300)]), rng.choice([None, "a", "b"]), rng.choice([None, [1, None], [None, 1]])) for _ in range(400)]
        other = [r for r in some if rng.random() > 0.02] + some[:5] + [(rng.randint(-9, 400), "new", []) for _ in range(turn)]
        left, right = (spark.createDataFrame(x, "k int, t string, n array<int>") for x in (some, other))
        paths = stored(spark, tmp_path / str(turn), left, right, ranges=40)
        assert rows(changed_rows_ranged(spark, *paths)) == rows(changed_rows(left, right))


def test_nulls_that_move_inside_a_value_are_seen(spark, tmp_path):
    left, right = (spark.createDataFrame([(1, x, y, z)], "k int, a array<int>, b string, c string") for x, y, z in (
        ([1, None], None, "s"), ([None, 1], None, "s")))
    assert changed_rows_ranged(spark, *stored(spark, tmp_path, left, right)).count() == 2
    moved = spark.createDataFrame([(1, [1, None], "s", None)], left.schema)
    assert changed_rows_ranged(spark, *stored(spark, tmp_path / "m", left, moved)).count() == 2


def test_empty_sets(spark, tmp_path, numbers):
    none = numbers.where("false")
    assert changed_rows_ranged(spark, *stored(spark, tmp_path / "a", none, none)).collect() == []
    assert changed_rows_ranged(spark, *stored(spark, tmp_path / "b", none, numbers)).count() == 5000
    assert changed_rows_ranged(spark, *stored(spark, tmp_path / "c", numbers, none)).count() == 5000


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(12,2)", "double", "int"])
def test_range_is_the_number_of_edges_passed(spark, kind):
    of = "date_add(date'2024-01-01', cast(id as int))" if kind in ("date", "timestamp", "timestamp_ntz") else "id"
    df = spark.range(400).selectExpr(f"cast({of} as {kind}) k")
    edges = range_edges(df, "k", 37)
    got = df.select("k", range_of(F.col("k"), edges, kind).alias("r")).collect()
    assert len(edges) == 36 and all(r.r == sum(e <= r.k for e in edges) for r in got)


def test_what_cannot_be_compared_is_refused(spark, tmp_path, numbers):
    with pytest.raises(ColumnTypeError):
        store_ranged(numbers, f"{tmp_path}/t", "odd name")
    with pytest.raises(ValueError):
        store_ranged(numbers.withColumn("_range", F.lit(1)), f"{tmp_path}/t", "k")
    store_ranged(numbers, f"{tmp_path}/l", "k", 10)
    store_ranged(numbers.where("k > 100"), f"{tmp_path}/r", "k", 10)
    with pytest.raises(RangeEdgesError):
        differing_ranges(spark, f"{tmp_path}/l", f"{tmp_path}/r")
    with pytest.raises(RangeEdgesError):
        store_ranged(numbers, f"{tmp_path}/v", "v", like=f"{tmp_path}/l")
    store_ranged(numbers.withColumn("v", F.col("v").cast("int")), f"{tmp_path}/i", "k", like=f"{tmp_path}/l")
    with pytest.raises(ColumnTypeError):
        changed_rows_ranged(spark, f"{tmp_path}/l", f"{tmp_path}/i")
