"""Data sets stored by key range with a tree of digests, compared where the digests differ.

``store_ranged`` writes a data set as folders of one key range each, and beside it the digests of
the ranges, of groups of ranges and of all. Two data sets that were stored with the same edges
(``like`` takes those of the other) are compared from the top of the tree down; only the rows of
ranges whose digests differ are read. A correction of one day or one block of numbers costs
a read of its ranges, however large the rest is.

A digest is the number of rows and, for two hash functions, the sum and the exclusive-or of the
row hashes. Equal digests stand for equal rows (128 bits of hash); different ones cost a read, no more, so
copies of a row, which the comparison does not count, never make a wrong result.

Edges are quantiles of the key, so ranges have about as many rows each; a key with very many rows
is one range, whose files Spark still splits when it writes (rebalancing) and reads. Null keys
are in the first range. An empty data set has no edges and at most that range.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from callweave.operators.compare import ColumnTypeError, changed_rows, schema_differences

RANGES = 1024
#: Ranges that share a node of the tree, and nodes that share one above.
FANOUT = 32
#: Types whose quantiles Spark has, so a key is of one of them.
KEY_TYPES = ("byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz")
RANGE = "_range"


class RangeEdgesError(ValueError):
    """The two data sets were stored with different edges, so their ranges do not correspond."""


def range_edges(df: DataFrame, key: str, ranges: int = RANGES) -> list:
    """Increasing edges that part the keys into at most ``ranges`` ranges of about equal size."""
    kind = df.schema[key].dataType.typeName()
    if kind not in KEY_TYPES:
        raise ColumnTypeError(f"{key} is {kind}; ranges need one of {', '.join(KEY_TYPES)}")
    if ranges < 2:
        return []
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return sorted(set(df.agg(F.percentile_approx(f"`{key}`", shares, ranges * 10)).first()[0] or []))


def range_of(key: Column, edges: Sequence, kind: str) -> Column:
    """Number of the range: how many edges are not above the key. Blocks of edges are passed over
    first, then the edges of one block, so a row is compared with some 2 * sqrt(edges) of them."""
    if not edges:
        return F.lit(0)
    width = max(int(len(edges) ** 0.5), 1)
    blocks = [list(edges[i : i + width]) for i in range(0, len(edges), width)]
    literal = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    passed = F.size(F.filter(literal([b[-1] for b in blocks]), lambda edge: edge <= key))
    block = F.get(F.array(*[literal(b) for b in blocks]), passed)
    return F.coalesce(passed * width + F.size(F.filter(block, lambda edge: edge <= key)), F.lit(len(edges)))


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of the values by column name. Nulls are hashed as such, and nested values as text,
    since Spark's hash passes over nulls."""
    values = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        column = F.col(f"`{field.name}`")
        nested = field.dataType.typeName() in ("array", "struct", "map", "variant")
        values += [F.isnull(column), F.to_json(F.struct(column)) if nested else column]
    return [F.xxhash64(F.lit(seed), *values) for seed in (1, 2)]


def _digests() -> list[Column]:
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(f"sum{c}")
    return [F.count("*").alias("n_rows"), wide("_a"), wide("_b"), F.bit_xor("_a").alias("xor_a"), F.bit_xor("_b").alias("xor_b")]


def store_ranged(df: DataFrame, folder: str, key: str, ranges: int = RANGES, like: str | None = None) -> None:
    """Write ``folder``/rows (Parquet by range), ``folder``/digests and, last, ``folder``/edges. With ``like``, the key and
    edges are those of the data set stored there. ``df`` is read once for the edges and once for the rows. The folder
    has to be a new one: a store that failed half-way has no edges, so it is never taken for a whole one."""
    spark = df.sparkSession
    if RANGE in df.columns:
        raise ValueError(f"a column named {RANGE} is there already")
    kind = df.schema[key].dataType.simpleString()
    if like is None:
        edges = range_edges(df, key, ranges)
    else:
        known = spark.read.parquet(f"{like}/edges").first()
        if (known["key"], known["kind"]) != (key, kind):
            raise RangeEdgesError(f"{like} has ranges of {known['key']} {known['kind']}, not of {key} {kind}")
        edges = list(known["edges"])
    placed = df.withColumn(RANGE, range_of(F.col(f"`{key}`"), edges, kind))
    placed.hint("rebalance", RANGE).write.partitionBy(RANGE).parquet(f"{folder}/rows")
    stored = spark.read.schema(placed.schema).parquet(f"{folder}/rows")
    a, b = _row_hashes(df)
    leaves = stored.select(RANGE, a.alias("_a"), b.alias("_b")).groupBy(F.col(RANGE).alias("node")).agg(*_digests())
    leaves.select(F.lit(0).alias("level"), "*").write.parquet(f"{folder}/digests")
    level = 0
    while FANOUT**level < len(edges) + 1:  # sums and exclusive-ors of the children make the parent
        level += 1
        add = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c)
        below = spark.read.parquet(f"{folder}/digests").where(F.col("level") == level - 1)
        above = below.groupBy(F.expr(f"cast(node div {FANOUT} as int)").alias("node")).agg(
            F.sum("n_rows").alias("n_rows"), add("sum_a"), add("sum_b"), F.bit_xor("xor_a").alias("xor_a"), F.bit_xor("xor_b").alias("xor_b"))
        above.select(F.lit(level).alias("level"), "*").coalesce(1).write.mode("append").parquet(f"{folder}/digests")
    edge_row = spark.range(1).select(F.lit(key).alias("key"), F.lit(kind).alias("kind"), F.lit(level).alias("levels"),
                                     F.lit(placed.schema.json()).alias("schema"),
                                     F.array(*[F.lit(e).cast(kind) for e in edges]).cast(f"array<{kind}>").alias("edges"))
    edge_row.write.parquet(f"{folder}/edges")


def differing_ranges(spark: SparkSession, left: str, right: str) -> list[int]:
    """Ranges whose digests differ. Each level reads the children of the nodes that differ above only;
    at most as many numbers as there are ranges come to the driver."""
    tops = [spark.read.parquet(f"{side}/edges").first() for side in (left, right)]
    if any(tops[0][name] != tops[1][name] for name in ("key", "kind", "edges")):
        raise RangeEdgesError(f"{left} and {right} were stored with different edges")
    sides = [spark.read.parquet(f"{side}/digests") for side in (left, right)]
    nodes = [0]
    for level in range(tops[0]["levels"], -1, -1):
        both = sides[0].unionByName(sides[1]).where((F.col("level") == level) & F.col("node").isin(nodes))
        values = ["node", "n_rows", "sum_a", "sum_b", "xor_a", "xor_b"]
        differ = both.groupBy(*values).count().where("count = 1").select("node").distinct()
        found = sorted(r["node"] for r in differ.collect())
        if not found or level == 0:
            return found
        nodes = [n * FANOUT + i for n in found for i in range(FANOUT)]
    return []


def stored_rows(spark: SparkSession, folder: str, ranges: Sequence[int] | None = None) -> DataFrame:
    """Rows of a stored data set; of some ranges only, which Spark then picks by folder."""
    schema = spark.read.parquet(f"{folder}/edges").first()["schema"]  # no file has it if there are no rows
    rows = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{folder}/rows")
    return (rows if ranges is None else rows.where(F.col(RANGE).isin(list(ranges)))).drop(RANGE)


def changed_rows_ranged(spark: SparkSession, left: str, right: str, drop: Sequence[str] = ()) -> DataFrame:
    """As ``changed_rows``, for two stored data sets, reading only ranges that differ."""
    sides = [stored_rows(spark, side) for side in (left, right)]
    if differences := schema_differences(*sides):
        raise ColumnTypeError("; ".join(f"{n}: {a} against {b}" for n, a, b in differences))
    ranges = differing_ranges(spark, left, right)
    return changed_rows(*(stored_rows(spark, side, ranges) for side in (left, right)), drop=drop)
