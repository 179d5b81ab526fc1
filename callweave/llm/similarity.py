"""Exact links inside families: groups of texts that a looser test has connected.

Every similar pair lies in one family, so only members of a family are compared, by their sets of shingle
hashes. Rejected pairs exist only as numbers in a task's arrays; what a task reports is a forest: at most one
link for each member that it has, and only links of similar texts.

A family is cut into blocks of ``BLOCK`` members (fewer if their sets are large). First every block is compared
within itself, together with the family's first member, which connects blocks of real copies. For families
that are still in several components, pairs of blocks follow, but none whose members are all of one component: members
are dealt to blocks by component. So each set is sent to one task in the first turn, and in the second
only as often as its component has others to be compared with.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callweave.llm.common import batch_of, one_array, ranges
from callweave.llm.components import components

#: Members of a block, at most on average, and hashes of their sets.
BLOCK, BLOCK_HASHES = 512, 1 << 19
#: Hashes that go to one task of Spark, on average.
TASK_HASHES = 4 << 20

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def forest(side: np.ndarray, group: np.ndarray, fp: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, radius: int, similarity: float):
    """Index pairs of a forest that connects all pairs of rows of different sides (side 2: any) and different groups whose fingerprints are within the
    radius and whose sets, standing one after another in ``hashes``, are so similar."""
    n, begins = len(sizes), np.cumsum(sizes) - sizes
    names, values = np.unique(hashes, return_inverse=True)
    inside = np.zeros(len(names), bool)
    label = np.unique(group, return_inverse=True)[1]
    for row in range(n - 1):
        others = np.arange(row + 1, n)
        others = others[(label[others] != label[row]) & ((side[others] != side[row]) | (side[row] == 2))]
        small, large = np.minimum(sizes[others], sizes[row]), np.maximum(sizes[others], sizes[row])
        others = others[(small >= similarity * large) & (small > 0)]
        others = others[np.bitwise_count(fp[others] ^ fp[row]).sum(axis=1, dtype=np.int64) <= radius]
        if not len(others):
            continue
        own = values[begins[row] : begins[row] + sizes[row]]
        inside[own] = True
        shared = np.add.reduceat(inside[values[ranges(begins[others], sizes[others])]], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        inside[own] = False
        for other in others[shared / (sizes[others] + sizes[row] - shared) >= similarity].tolist():
            if label[other] != label[row]:
                label[label == label[other]] = label[row]
                yield row, other


def _tasks(batches):
    """Columns of all rows of one task after another; rows come in order of ``task``."""
    parts, task = [], None
    for batch in batches:
        tasks = batch.column("task").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(tasks)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                if parts and tasks[a] != task:
                    yield pa.Table.from_batches(parts)
                    parts = []
                task = tasks[a]
                parts.append(batch.slice(a, b - a))
    if parts:
        yield pa.Table.from_batches(parts)


def compared(rows: DataFrame, names: list[str], parts: int, radius: int, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` of nodes, from rows with ``task``, ``side``, ``group``, ``node``, the fingerprint ``names`` and ``hashes``."""

    def compare(batches):
        for table in _tasks(batches):
            lists = one_array(table.column("hashes"))
            sizes = lists.value_lengths().to_numpy()
            side, group, node, *fp = (table.column(c).to_numpy() for c in ("side", "group", "node", *names))
            fp = np.stack(fp, axis=1).view(np.uint64)
            found = list(forest(side, group, fp, sizes, lists.flatten().to_numpy(), radius, similarity))
            if found:
                a, b = np.array(found).T
                yield batch_of(_EDGES, node[a], node[b])

    rows = rows.select("task", "side", "group", "node", *names, "hashes")
    return rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(compare, "a long, b long")


def family_links(kept, members: DataFrame, names: list[str], radius: int, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` that connect all similar members of each family. ``members``, a stage table: ``family`` (its least node),
    ``node``, the fingerprint ``names`` and ``hashes``."""
    spark = members.sparkSession
    n = members.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / TASK_HASHES))
    sizes = members.groupBy("family").agg(F.count("*").alias("n"), F.sum(F.size("hashes")).alias("hashes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("hashes") / BLOCK_HASHES)).cast("long")
    sizes = kept.keep(sizes.select("family", blocks.alias("blocks")), "sizes")
    dealt = members.join(sizes, "family")
    # The first member goes to all blocks of its family.
    block = F.when(F.col("node") == F.col("family"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("node"), F.col("blocks")))
    )
    first = dealt.select("*", F.explode(block).alias("block")).withColumns(
        {"task": F.xxhash64("family", "block"), "side": F.lit(2), "group": F.col("node")}
    )
    within = kept.keep(compared(first, names, parts, radius, similarity), "within")
    large = sizes.where("blocks > 1")
    if large.isEmpty():
        return within
    return within.unionByName(kept.keep(_across(kept, members, large, within, names, parts, radius, similarity), "across"))


def _across(kept, members: DataFrame, large: DataFrame, within: DataFrame, names: list[str], parts: int, radius: int, similarity: float) -> DataFrame:
    """Links between blocks of families that the first turn left in several components."""
    grouped = members.join(large.select("family"), "family", "left_semi").join(components(within).withColumnRenamed("root", "group"), "node", "left")
    grouped = kept.keep(grouped.withColumn("group", F.coalesce("group", "node")), "grouped")
    weight = F.greatest(F.count("*") / BLOCK, F.sum(F.size("hashes")) / BLOCK_HASHES).alias("weight")
    groups = kept.keep(grouped.groupBy("family", "group").agg(weight), "groups")
    # A component of a block's size or more has blocks of its own; smaller ones are dealt to common blocks.
    common = groups.where("weight < 1").groupBy("family").agg(F.ceil(F.sum("weight")).cast("long").alias("n"))
    dealt = groups.join(common, "family", "left").select(
        "family", "group", F.when(F.col("weight") >= 1, F.col("group")).alias("owner"),
        F.when(F.col("weight") >= 1, F.ceil("weight")).otherwise(F.col("n")).cast("long").alias("n"),
    )
    dealt = kept.keep(dealt, "dealt")
    own = F.struct("owner", F.sequence(F.lit(0), F.col("n") - 1).alias("places"))
    blocks = dealt.where("owner is not null").select("family", own.alias("x")).unionByName(
        dealt.where("owner is null").groupBy("family").agg(F.max("n").alias("n")).select("family", F.struct(F.lit(None).cast("long").alias("owner"), F.sequence(F.lit(0), F.col("n") - 1).alias("places")).alias("x"))
    ).select("family", "x.owner", F.explode("x.places").alias("place"))
    # Pairs of blocks of a family, the second not before the first; none inside one component.
    blocks = kept.keep(blocks.withColumn("block", F.struct(F.coalesce("owner", F.lit(-1)).alias("owner"), "place")), "blocks")
    pairs = blocks.select("family", F.col("block").alias("i"), F.col("owner").alias("owner_i")).join(
        blocks.select("family", F.col("block").alias("j"), F.col("owner").alias("owner_j")), "family"
    ).where((F.col("i") <= F.col("j")) & (F.col("owner_i").isNull() | F.col("owner_j").isNull() | (F.col("owner_i") != F.col("owner_j"))))
    task = F.xxhash64("family", "i", "j")
    same = F.col("i") == F.col("j")
    ends = pairs.select("family", F.explode(F.when(same, F.array(F.struct(F.col("i").alias("block"), F.lit(2).alias("side")))).otherwise(
        F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("block"), F.lit(1).alias("side")))
    )).alias("end"), task.alias("task")).select("family", "end.block", "end.side", "task")
    spread = F.when(F.col("owner").isNotNull(), F.pmod(F.xxhash64("node"), F.col("n"))).otherwise(F.pmod(F.xxhash64("group"), F.col("n")))
    placed = grouped.join(dealt, ["family", "group"]).withColumn("block", F.struct(F.coalesce("owner", F.lit(-1)).alias("owner"), spread.alias("place")))
    return compared(placed.join(ends, ["family", "block"]), names, parts, radius, similarity)
