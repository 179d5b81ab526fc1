"""Operators on whole rows: union, repetition, role fan-out, total order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def union_aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, in the columns of the left one; further columns of the right
    one are dropped, a missing one is an error."""
    return left.unionByName(right.select(*[f"`{c}`" for c in left.columns]))


def repeat_rows(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times (once for less than 2), in one scan."""
    if times <= 1:
        return df
    copies = F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_copy")
    return df.select("*", copies).drop("_copy")


def explode_roles(
    df: DataFrame, roles: Sequence[tuple[Column, Mapping[str, Column]]]
) -> DataFrame:
    """Turn one row into one row per role whose condition holds, in a single scan.

    A role is a condition and the columns it sets; all roles set the same columns. A
    row that fits no role (also by a null condition) disappears.
    """
    names = list(roles[0][1])
    legs = F.array(
        *[
            F.when(condition, F.struct(*[values[n].alias(n) for n in names]))
            for condition, values in roles
        ]
    )
    kept = [f"`{c}`" for c in df.columns if c not in names]
    legged = df.select("*", F.explode(legs).alias("_leg")).where(F.col("_leg").isNotNull())
    return legged.select(*kept, *[F.col("_leg")[n].alias(n) for n in names])


def top_order(df: DataFrame) -> DataFrame:
    """Distinct rows in the total order of all columns (range-partitioned sort)."""
    return df.distinct().orderBy(*[f"`{c}`" for c in df.columns])


def distinct_in_ranges(df: DataFrame) -> DataFrame:
    """Distinct rows in the total order of all columns, with one shuffle: by ranges of the whole row, which
    bring equal rows together, so that each task drops copies and sorts. Copies are shuffled, too, so
    this is for rows of which few are copies.

    The rows are one struct meanwhile: Spark takes constant columns out of single keys, and then the ranges
    no longer serve the aggregation. Should a plan shuffle by hash after all, ``top_order`` is taken.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    made = rows.repartitionByRange("_row").distinct().sortWithinPartitions("_row")
    plan = made._jdf.queryExecution().executedPlan().toString()
    shuffles = plan.count("hashpartitioning(_row#")
    return top_order(df) if shuffles else made.select("_row.*")
