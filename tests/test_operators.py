import random

import pytest
from pyspark.sql import functions as F

from callweave.operators import (
    anti_join,
    attach_by_key,
    changed_rows,
    diff_by_column,
    diff_summary,
    explode_roles,
    fingerprint,
    group_total,
    joined_labels,
    latest_per_key,
    latest_version,
    mark_first,
    missing_columns,
    normalize_for_diff,
    null_safe_join,
    prefix_lookup,
    repeat_rows,
    require_columns,
    require_parents,
    require_schema,
    schema_differences,
    tolerance_join,
    top_order,
    union_aligned,
)
from callweave.operators.compare import ColumnCountError, ColumnTypeError
from callweave.operators.contract import ColumnContractError
from checks import building_blocks
from conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_union_aligned(spark):
    left = spark.createDataFrame([("nom1", "1", "2")], "nom string, de string, longueur string")
    right = spark.createDataFrame([("9", "x", "8", "nom2")], "longueur string, more string, de string, nom string")
    both = union_aligned(left, right)
    assert both.columns == ["nom", "de", "longueur"]
    assert rows(both) == [("nom1", "1", "2"), ("nom2", "8", "9")]
    with pytest.raises(Exception):
        union_aligned(right, left)


@pytest.mark.parametrize("times,expected", [(-1, 1), (0, 1), (1, 1), (5, 5)])
def test_repeat_rows(spark, times, expected):
    assert repeat_rows(spark.range(3), times).count() == 3 * expected


def test_explode_roles_null_condition_gives_no_row(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 14)], "id int, t int")
    roles = [
        (F.col("t") != 14, {"kind": F.lit("one")}),
        (F.col("t") == 14, {"kind": F.lit("out")}),
        (F.col("t") == 14, {"kind": F.lit("in")}),
    ]
    assert rows(explode_roles(df, roles), "id", "kind") == [(1, "one"), (3, "in"), (3, "out")]


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("a", 3, 9), ("b", None, 4)], "k string, ts int, i int")
    latest = latest_per_key(df, ["k"], [F.desc("ts"), F.desc("i")])
    assert rows(latest) == [("a", 3, 9), ("b", None, 4)]
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_latest_version_drops_a_unit_whose_latest_version_is_invalid(spark):
    data = [("a", "20200101", "x"), ("a", "99999999", "z"), ("a", "99999999", "y"),
            ("b", "20210101", "x"), (None, "99999999", "x"), ("c", None, "x")]
    df = spark.createDataFrame(data, "k string, v string, t string")
    assert rows(latest_version(df, "k", "v", F.col("v") == "99999999", ["t"])) == [("a", "99999999", "y")]


def test_mark_first_with_null_keys(spark):
    data = [(1, "d", "n", 5, 4), (2, "d", "n", 3, 4), (3, "d", "n", 3, 9), (4, "d", None, 1, 4), (5, "d", "n", 1, 9)]
    df = spark.createDataFrame(data, "id int, d string, n string, s int, t int")
    got = mark_first(df, ["d", "n"], "s", F.col("t") == 4, "first")
    assert rows(got, "id", "first") == [(1, False), (2, True), (3, True), (4, False), (5, False)]


@pytest.mark.parametrize("heavy", [1, 2, 256])
def test_group_total_equals_window_except_for_null_keys(spark, heavy):
    rnd = random.Random(3)
    data = [(i, rnd.choice(["hot"] * 20 + ["b", "c", None]), rnd.choice(["x", "y", None]), rnd.choice([0, 1, None]))
            for i in range(600)]
    df = spark.createDataFrame(data, "id int, k string, d string, v int")
    totals = df.groupBy("k", "d").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    got = {r.id: r.total for r in attach_by_key(df, totals, ["k", "d"], ["total"], "n", ["id"], heavy).collect()}
    sums = {}
    for _, k, d, v in data:
        if v is not None:
            sums[k, d] = sums.get((k, d), 0) + v
    assert got == {i: None if k is None or d is None else sums.get((k, d)) for i, k, d, _ in data}


def test_group_total_aggregates_once(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.lit(1).alias("v"))
    got = group_total(df, ["k"], "v", "total", ["id"])
    assert got.count() == 1000 and got.where("total is null").isEmpty()
    got.collect()
    final = plan_of(got).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or "ReusedQueryStage" in final or final.count("partial_sum") == 1


def test_hot_and_null_keys_are_spread_over_partitions(spark):
    df = spark.range(4000).select(
        "id", F.when(F.col("id") < 3000, 1).when(F.col("id") < 3500, None).otherwise(F.col("id")).alias("k"),
    )
    totals = df.groupBy("k").agg(F.count("id").alias("total"), F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = attach_by_key(df, totals, ["k"], ["total"], "n", ["id"], heavy_keys=1)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(sizes) < 4000 / 4 * 1.3


def test_joined_labels_sorted_with_duplicates(spark):
    df = spark.createDataFrame([("351", "Portugal"), ("351", "Madeira"), ("49", "A"), ("49", "A"), ("7", None)], "c string, p string")
    assert rows(joined_labels(df, ["c"], "p", "p")) == [("351", "Madeira, Portugal"), ("49", "A, A"), ("7", "")]


def brute_pairs(left, right, tolerance):
    return sorted((i, j, abs(s - t)) for i, k, s in left for j, m, t in right
                  if k is not None and k == m and s is not None and t is not None and abs(s - t) <= tolerance)


@pytest.mark.parametrize("tolerance", [0, 1, 4, 37])
@pytest.mark.parametrize("bucketed", [True, False])
def test_tolerance_join_equals_brute_force(spark, tolerance, bucketed):
    rnd = random.Random(tolerance)
    keys = ["15"] * 8 + ["0612", "18", None]
    left = [(i, rnd.choice(keys), rnd.choice([None, *range(-50, 400)])) for i in range(300)]
    right = [(i, rnd.choice(keys), rnd.randrange(-50, 400)) for i in range(150)] + [(999, "15", None)]
    pairs = tolerance_join(
        spark.createDataFrame(left, "i int, k string, s bigint"),
        spark.createDataFrame(right, "j int, m string, t bigint"),
        "k", "m", "s", "t", tolerance, bucketed=bucketed,
    )
    assert pairs.columns == ["i", "k", "s", "j", "m", "t", "date_diff"]
    assert sorted(tuple(r) for r in pairs.select("i", "j", "date_diff").collect()) == brute_pairs(left, right, tolerance)


def test_prefix_lookup_distinct_and_per_listing(spark):
    numbers = spark.createDataFrame([("0612345678",), ("3012",), ("3112",), ("15",), (None,)], "n string")
    plan = spark.createDataFrame([("06", "10"), ("30", "4"), ("30", "4"), ("15", "10"), (None, None)], "Debut string, Longueur string")
    once = prefix_lookup(numbers, "n", 2, plan, "hit")
    assert rows(once) == [(None, False), ("0612345678", True), ("15", False), ("3012", True), ("3112", False)]
    listed = prefix_lookup(numbers, "n", 2, plan, "hit", duplicates=True)
    assert sorted(r.n for r in listed.where("hit").collect()) == ["0612345678", "3012", "3012"]
    assert listed.count() == 6


def test_prefix_lookup_gives_the_number_of_listings(spark):
    numbers = spark.createDataFrame([("0612345678",), ("3012",), ("3012",), ("3112",), (None,)], "n string")
    plan = spark.createDataFrame([("06", "10"), ("30", "4"), ("30", "4"), ("30", "4"), (None, None)], "Debut string, Longueur string")
    counted = prefix_lookup(numbers, "n", 2, plan, "hit", duplicates=True, times="times")
    assert rows(counted) == [(None, False, 1), ("0612345678", True, 1), ("3012", True, 3), ("3012", True, 3), ("3112", False, 1)]
    listed = prefix_lookup(numbers, "n", 2, plan, "hit", duplicates=True)
    assert rows(listed.groupBy("n", "hit").count()) == rows(counted.groupBy("n", "hit").agg(F.sum("times")))


def test_listings_are_counted_without_a_row_for_each(spark, tmp_path):
    parts = [(1, "Brand#11"), (1, "Brand#11"), (2, "Brand#23"), (3, "Brand#3"), (4, None), (None, "Brand#12")]
    spark.createDataFrame(parts, "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    keys = [(1,), (11,), (11,), (21,), (2,), (3,), (None,)]
    spark.createDataFrame(keys, "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    found = building_blocks.prefix_of_brand(spark, str(tmp_path))
    assert rows(found) == [(None, "Brand#12", 4), (1, "Brand#11", 8), (2, "Brand#23", 1), (3, "Brand#3", 0), (4, None, 0)]
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_is_the_same_without_broadcast(spark):
    numbers = spark.createDataFrame([("3012",), ("3112",)], "n string")
    plan = spark.createDataFrame([("30", "4")], "Debut string, Longueur string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(prefix_lookup(numbers, "n", 2, plan, "hit")) == [("3012", True), ("3112", False)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (None, "a")], "k int, t string")
    assert rows(anti_join(left, left, ["k", "t"])) == [(None, "a"), (2, None)]


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "i int, k string")
    right = spark.createDataFrame([("a", 1), (None, 2)], "r string, v int")
    assert rows(null_safe_join(left, right, "k", "r"), "i", "v") == [(1, 1), (2, 2)]


def test_require_parents(spark):
    units = spark.createDataFrame([("0100029", "01000"), ("0200029", "02000"), ("x", None)], "code string, ci string")
    parents = spark.createDataFrame([("01000", "Centre")], "code string, label string")
    assert rows(require_parents(units, parents, "ci", "code")) == [("0100029", "01000")]
    carried = require_parents(units, parents, "ci", "code", {"label": "centre"})
    assert rows(carried, "code", "centre") == [("0100029", "Centre")]


def test_contracts(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert missing_columns(df, ["name", "Name", "x"]) == ["Name", "x"]
    assert require_columns(df, ["id"]) is df
    with pytest.raises(ColumnContractError, match="x, y"):
        require_columns(df, ["id", "x", "y"])
    assert require_schema(df, "name string, id int").columns == ["name", "id"]
    with pytest.raises(ColumnContractError, match="id is int"):
        require_schema(df, "id bigint")


def test_top_order(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (1, "a"), (2, "b")], "i int, t string")
    assert [tuple(r) for r in top_order(df).collect()] == [(1, "a"), (1, "z"), (2, "b")]


def versions(spark):
    left = spark.createDataFrame([(1, "a", 5.0), (2, "b", None), (2, "b", None), (3, "c", 1.0), (None, "n", 1.0)], "id int, t string, v double")
    right = spark.createDataFrame([(5.0, "a", 1), (None, "b", 2), (2.0, "c", 3), (4.0, "d", 4), (1.0, "n", None)], "v double, t string, id int")
    return left, right


def test_dataset_diff(spark):
    left, right = versions(spark)
    assert rows(changed_rows(left, right)) == [(3, "c", 1.0, "left"), (3, "c", 2.0, "right"), (4, "d", 4.0, "right")]
    assert rows(diff_summary(left, right)) == [(5, 5, 1, 2)]
    assert rows(changed_rows(left, right, drop=["v"])) == [(4, "d", "right")]
    assert rows(diff_by_column(left, right, "id")) == [
        ("t", 4, "d", "right"), ("v", 3, "1.0", "left"), ("v", 3, "2.0", "right"), ("v", 4, "4.0", "right"),
    ]


def test_dataset_diff_of_equal_and_empty_data(spark):
    left, _ = versions(spark)
    assert changed_rows(left, left).isEmpty()
    empty = left.limit(0)
    assert rows(diff_summary(empty, empty)) == [(0, 0, 0, 0)]


def test_dataset_diff_names_columns_when_counts_differ(spark):
    left, right = versions(spark)
    with pytest.raises(ColumnCountError, match="3 columns against 2.*'v'"):
        changed_rows(left, right.drop("v"))


def test_normalize_for_diff(spark):
    df = spark.createDataFrame([("1.50", "2022-04-27 10:00:00.000", '"x"', " s ", "n")], "a string, t string, q string, s string, d string")
    got = normalize_for_diff(df, to_double=["a"], to_iso=["t"], strip_quotes=["q"], trim=["s"], rename={"a": "b"}, drop=["d"])
    assert got.columns == ["b", "t", "q", "s"]
    assert rows(got) == [(1.5, "2022-04-27T10:00:00", "x", "s")]


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_fingerprint_ignores_order_but_not_values(spark, method):
    df = spark.range(100).select("id", (F.col("id") * 2).cast("string").alias("t"))
    same = fingerprint(df.orderBy(F.desc("id")).repartition(7), method).collect()
    assert fingerprint(df, method).collect() == same
    changed = df.withColumn("t", F.when(F.col("id") == 5, "x").otherwise(F.col("t")))
    assert fingerprint(changed, method).collect() != same
    doubled = fingerprint(df.union(df), method).collect()[0]
    assert doubled.n_rows == 200 and doubled.hash_sum != same[0].hash_sum


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_fingerprint_sees_nulls_and_borders(spark, method):
    schema = "a string, b string"
    prints = [
        tuple(fingerprint(spark.createDataFrame([row], schema), method).collect()[0])
        for row in [("x", None), (None, "x"), ("\\N", "x"), ("x", ""), ("", "x"), ("x,1:y", "z"), ("x", "y,1:z"), (None, None), ("-", "-")]
    ]
    assert len(set(prints)) == len(prints)


def test_dataset_diff_by_place_and_types(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    other = spark.createDataFrame([(1, "x"), (3, "y")], "key int, w string")
    assert rows(changed_rows(left, other)) == [(2, "y", "left"), (3, "y", "right")]
    assert schema_differences(left, other) == [("id", "int", None), ("v", "string", None), ("key", None, "int"), ("w", None, "string")]
    with pytest.raises(ColumnTypeError, match="id: int against string"):
        changed_rows(left, left.withColumn("id", F.col("id").cast("string")))


def test_building_a_lookup_runs_no_job(spark):
    numbers = spark.createDataFrame([("3012",)], "n string")
    plan = spark.createDataFrame([("30", "4")], "Debut string, Longueur string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup", "building only")
    try:
        prefix_lookup(numbers, "n", 2, plan, "hit")
        assert not list(tracker.getJobIdsForGroup("lookup"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_joined_labels_once_each(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "b"), ("2", None)], "k string, label string")
    assert rows(joined_labels(df, ["k"], "label", "t")) == [("1", "a, b, b"), ("2", "")]
    assert rows(joined_labels(df, ["k"], "label", "t", distinct=True)) == [("1", "a, b"), ("2", "")]
