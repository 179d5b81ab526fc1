"""A third of all rows on one key: the joins that are left to adaptive execution must come out
with a split partition, and the aggregates must shrink before their shuffle."""

import contextlib

import pytest
from pyspark.sql import functions as F

from callweave.operators import (
    anti_join,
    changed_rows,
    enrich,
    joined_labels,
    mark_first,
    null_safe_join,
    require_parents,
    tolerance_join,
)
from callweave.plans import ivr_prep

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot_rows(spark, rows=30_000):
    """``k`` is 'hot' for a third of the rows, spread over eight map tasks."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(0, rows, 1, 8).select(
        "id", key.alias("k"), F.xxhash64("id").alias("payload"), (F.col("id") % 5).alias("s")
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def lookup(spark):
    return spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "r string, v int").repartition(4)


JOINS = {
    "tolerance": lambda s: tolerance_join(
        hot_rows(s), lookup(s).withColumn("t", F.lit(2).cast("bigint")), "k", "r", "s", "t", 4
    ),
    "enrich": lambda s: enrich(hot_rows(s), lookup(s), "k", "r"),
    "null safe": lambda s: null_safe_join(hot_rows(s), lookup(s), "k", "r"),
    "anti": lambda s: anti_join(hot_rows(s), lookup(s).withColumnRenamed("r", "k"), ["k"]),
    "parents": lambda s: require_parents(hot_rows(s), lookup(s), "k", "r"),
    "first leg": lambda s: mark_first(
        hot_rows(s).withColumn("s", F.length("k")), ["k"], "s", F.col("id") < 20_000, "first"
    ),
}


@pytest.mark.parametrize("name", JOINS)
def test_hot_key_is_split(spark, name):
    with settings(spark, SMALL):
        assert "skew=true" in final_plan(JOINS[name](spark))


def shuffled_rows(df):
    """Rows written by the shuffles of a query, counted from the metrics of its final plan."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_copies_collapse_before_the_shuffle_of_a_comparison(spark):
    left = spark.range(0, 40_000, 1, 8).select((F.col("id") % 10).alias("a"), F.lit("x").alias("b"))
    assert max(shuffled_rows(changed_rows(left, left.withColumn("b", F.lit("y"))))) <= 10 * 16


def test_blocks_of_a_call_collapse_before_the_shuffle(spark):
    blocks = spark.range(0, 40_000, 1, 8).select(
        F.lit("c1").alias("id"), F.col("id").cast("double").alias("timestamp"), F.lit("transfer_1").alias("bloc id"),
        F.lit("B").alias("bloc name"), F.lit(5).alias("duration (ms)"), F.lit("e").alias("event"),
        F.current_timestamp().alias("createdate"),
    )
    ddl = ("id string, caller string, called string, tenantname string, treename string, start double, "
           "duration double, endcause string, transferredto string")
    calls = spark.createDataFrame([("c1", "sip:15@x", "", "", "", 1.0, 1.0, "TRANSFERRED", None)], ddl)
    got = ivr_prep(blocks, calls)
    assert got.count() == 1
    assert max(shuffled_rows(got)) <= 8


def test_labels_of_a_code_are_whole(spark):
    got = joined_labels(hot_rows(spark, 300).withColumn("id", F.col("id").cast("string")), ["k"], "id", "ids")
    hot = got.where("k = 'hot'").collect()[0].ids
    assert sorted(hot.split(", "), key=int) == [str(i) for i in range(0, 300, 3)]
