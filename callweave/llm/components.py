"""Connected components of an edge table, by alternating large and small stars.

Each round is two joins on the edge table; nothing is collected but a count and a checksum.
Stars point to the least node of their component in the end. Least neighbours are aggregated
and joined back, so a node with very many edges is a skewed join, which adaptive execution
splits, and never one task's group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.llm.common import drop, stages


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges go from the smaller node a to the larger node b.
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return moved.where("x <> y").unionByName(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).select(
        F.col("x").alias("a"), F.col("y").alias("b")
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node it is connected with) for every node but the roots.

    ``edges`` has integer columns ``a`` and ``b``; loops, repeated and reversed edges are fine.
    """
    kept = stages(edges.sparkSession)
    now = kept.keep(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "0"
    )
    seen, turn = None, 0
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen, turn = state, turn + 1
        large = kept.keep(_large_star(now), f"{turn}-large")
        new = kept.keep(_small_star(large), f"{turn}")
        drop(kept, f"{turn - 1}", f"{turn}-large")
        now = new
