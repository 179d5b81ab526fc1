"""Grouping operators.

Each of them reduces rows before the shuffle: aggregates do so by partial aggregation,
and a ``row_number() == 1`` window by Spark's group limit, which passes on at most one
row per key and task. So no task ever gets all rows of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from callweave.functions.predicates import is_true
from callweave.operators.joins import attach_by_key


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order. The order should be total within a key;
    otherwise any of the tied rows is taken."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_version(
    df: DataFrame, key: str, version: str, valid: Column, ties: Sequence[str]
) -> DataFrame:
    """Row with the greatest version per key, if that row is valid. A key or version that
    is null is left out. Ties are broken by the smallest values of ``ties``."""
    known = df.where(F.col(key).isNotNull() & F.col(version).isNotNull())
    order = [F.desc(version), *[F.asc(c) for c in ties]]
    return latest_per_key(known, [key], order).where(valid)


def mark_first(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    among: Column,
    flag: str,
    only: Column | None = None,
) -> DataFrame:
    """Flag the rows whose keys and time equal those of the earliest row of their group,
    where only rows that fulfil ``among`` take part in finding the earliest one.

    ``only`` says which rows need the flag; the others get false without being shuffled.
    """
    first = (
        df.where(among)
        .groupBy(*[F.col(k).alias(f"_first_{k}") for k in keys])
        .agg(F.min(time).alias("_first_time"))
    )
    same = F.col(time) == F.col("_first_time")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_first_{k}"))
    asked = df if only is None else df.where(is_true(only))
    marked = asked.join(first, same, "left").withColumn(flag, F.col("_first_time").isNotNull())
    marked = marked.drop("_first_time", *[f"_first_{k}" for k in keys])
    if only is None:
        return marked
    return marked.unionByName(df.where(~is_true(only)).withColumn(flag, F.lit(False)))


def group_total(
    df: DataFrame, keys: Sequence[str], value: str, total: str, spread: Sequence[str]
) -> DataFrame:
    """Attach the sum of ``value`` over all rows with the same keys; null for a null key.

    A window would send all rows of a key to one task. Here the sums are aggregated with
    a partial step and joined back, the heaviest keys without a shuffle by key. ``df`` is
    read twice, so give a stored table if it is costly.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias(total), F.count("*").alias("_rows"))
    return attach_by_key(df, totals, keys, [total], "_rows", spread)


def joined_labels(
    df: DataFrame, keys: Sequence[str], label: str, name: str, separator: str = ", ",
    distinct: bool = False,
) -> DataFrame:
    """All labels of a key in one text, sorted; ``distinct`` names each once. For reference tables:
    the text holds every label, so a key must have few of them (countries per dial code)."""
    collected = F.collect_set(label) if distinct else F.collect_list(label)
    labels = F.array_join(F.array_sort(collected), separator)
    return df.groupBy(*keys).agg(labels.alias(name))


def dedup_on(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of the given columns."""
    return df.select(*columns).distinct()
