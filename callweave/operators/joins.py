"""Joins.

Hot keys. An equi-join whose sides both come out of a shuffle is left to adaptive
execution, which splits an oversized partition at run time. Where that cannot work
(a lookup aggregated on the very join keys is not shuffled again, so Spark has nothing
to split), ``attach_by_key`` deals with the heaviest keys itself.

Broadcast. A side is broadcast by hint only when it is bounded by construction (``limit``);
everything else, reference tables included, is left to Spark's own size threshold, which
adaptive execution checks against the bytes that a side turns out to have.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

HEAVY_KEYS = 256


def tolerance_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_seconds: str,
    right_seconds: str,
    tolerance: int,
    difference: str = "date_diff",
    bucketed: bool = True,
) -> DataFrame:
    """All pairs with equal keys whose whole seconds differ by at most ``tolerance``.

    The time axis is cut into buckets and the bucket joins the key, so a busy key is
    spread over its buckets instead of pairing all its rows. A right row is repeated for
    the buckets its tolerance interval touches (1.4 on average); a left row lies in one
    bucket, so each pair is found exactly once. Give the wider or longer table as
    ``left``. ``bucketed=False`` is the plain join, kept as a cross-check.
    """
    distance = F.abs(F.col(left_seconds) - F.col(right_seconds))
    near = (F.col(left_key) == F.col(right_key)) & (distance <= tolerance)
    if bucketed:
        width = 4 * (tolerance + 1)

        def bucket(seconds: Column) -> Column:
            return F.floor(seconds / width)

        left = left.withColumn("_left_bucket", bucket(F.col(left_seconds)))
        right = right.where(F.col(right_seconds).isNotNull()).withColumn(
            "_right_bucket",
            F.explode(
                F.sequence(
                    bucket(F.col(right_seconds) - tolerance),
                    bucket(F.col(right_seconds) + tolerance),
                )
            ),
        )
        near = near & (F.col("_left_bucket") == F.col("_right_bucket"))
    pairs = left.join(right, near, "inner").withColumn(difference, distance)
    return pairs.drop("_left_bucket", "_right_bucket")


def attach_by_key(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: str,
    spread: Sequence[str],
    heavy_keys: int = HEAVY_KEYS,
) -> DataFrame:
    """Left join of ``rows`` to a lookup with one row per key; null keys find nothing.

    ``weight`` is a positive number in the lookup that says how many rows have the key.
    The ``heavy_keys`` heaviest keys (a bounded list, whatever the data) are broadcast and
    answered without a shuffle; their rows, like rows with a null key, then pass the
    shuffled join spread by a hash of ``spread`` instead of by key. A key outside the list
    has less than ``1/heavy_keys`` of all rows.
    """
    # Both uses of the lookup start from the same filtered rows and keep the same columns, so
    # that its aggregation is computed once and its shuffle reused.
    has_key = reduce(and_, [F.col(k).isNotNull() for k in keys])
    known = lookup.where(has_key & (F.col(weight) > 0))
    heavy = known.orderBy(F.desc(weight), *keys).limit(heavy_keys)
    heavy = F.broadcast(
        heavy.select(
            F.struct(*values).alias("_heavy"), *[F.col(k).alias(f"_heavy_{k}") for k in keys]
        )
    )
    rest = known.select(
        F.struct(*values).alias("_rest"),
        F.xxhash64(*keys).alias("_rest_hash"),
        *[F.col(k).alias(f"_rest_{k}") for k in keys],
    )

    def same_key(prefix: str) -> Column:
        return reduce(and_, [F.col(k) == F.col(f"{prefix}{k}") for k in keys])

    by_hash = F.when(F.col("_heavy").isNull() & has_key, F.xxhash64(*keys)).otherwise(
        F.xxhash64(*spread)
    )
    attached = (
        rows.join(heavy, same_key("_heavy_"), "left")
        .withColumn("_hash", by_hash)
        .join(rest, (F.col("_hash") == F.col("_rest_hash")) & same_key("_rest_"), "left")
    )
    found = [F.coalesce(F.col("_heavy")[v], F.col("_rest")[v]).alias(v) for v in values]
    return attached.select(*[f"`{c}`" for c in rows.columns if c not in values], *found)


def prefix_lookup(
    df: DataFrame,
    number: str,
    prefix_length: Column | int,
    plan: DataFrame,
    hit: str,
    duplicates: bool = False,
    times: str | None = None,
) -> DataFrame:
    """Flag the rows whose number starts with a prefix of the numbering plan that is meant
    for numbers of that length (plan columns ``Debut`` and ``Longueur``).

    A plan that lists a prefix several times gives one row per call; with
    ``duplicates=True`` one row per listing, as a plain left join would. Those rows are calls
    times listings; if they are only to be counted or summed, name a column by ``times``: equal
    rows are then one with their number in it (1 without a hit).
    """
    prefixes = plan.select(
        F.col("Debut").alias("_prefix"), F.col("Longueur").try_cast("int").alias("_length")
    ).dropna()
    prefixes = prefixes.groupBy("_prefix", "_length").agg(F.count("*").alias("_listed"))
    length = F.lit(prefix_length) if isinstance(prefix_length, int) else prefix_length
    found = df.join(
        prefixes,
        (F.substring(F.col(number), F.lit(1), length) == F.col("_prefix"))
        & (F.length(number) == F.col("_length")),
        "left",
    ).withColumn(hit, F.col("_prefix").isNotNull())
    if duplicates:
        listed = F.coalesce(F.col("_listed"), F.lit(1))
        if times:
            found = found.withColumn(times, listed)
        else:
            copies = F.sequence(F.lit(1), listed.cast("int"))
            found = found.select("*", F.explode(copies).alias("_copy"))
    return found.drop("_prefix", "_length", "_listed", "_copy")


def dial_code_lookup(
    df: DataFrame,
    number: str,
    covered: DataFrame,
    countries: DataFrame,
    lengths: Sequence[int] = (2, 3),
    duplicates: bool = False,
) -> DataFrame:
    """One row per covered dial code that an international number starts with.

    ``covered`` has the codes of the numbering plan (``Indicatif``), ``countries`` one row
    per code with its label (``Indicatif``, ``Pays``). Rows without a covered code
    disappear. ``duplicates=True`` repeats a row for every listing of its code.
    """
    codes = (
        covered.select(F.col("Indicatif").alias("_covered"))
        .dropna()
        .groupBy("_covered")
        .agg(F.count("*").cast("int").alias("_listed"))
    )
    labels = countries.select(F.col("Indicatif").alias("_code"), "Pays")
    labelled = codes.join(labels, F.col("_covered") == F.col("_code"), "left")
    bare = F.regexp_replace(F.col(number), "^00", "")
    prefixes = F.explode(F.array(*[F.substring(bare, 1, n) for n in lengths]))
    hits = df.select("*", prefixes.alias("Indicatif_numero")).join(
        labelled, F.col("Indicatif_numero") == F.col("_covered"), "inner"
    )
    if duplicates:
        copies = F.explode(F.sequence(F.lit(1), F.col("_listed")))
        hits = hits.select("*", copies.alias("_copy"))
    return hits.drop("_covered", "_listed", "_code", "_copy")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a right row of the same keys; null keys never match, so rows
    that have one stay."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def null_safe_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join in which null equals null."""
    return left.join(right, F.col(left_key).eqNullSafe(F.col(right_key)), "inner")


def enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on keys of different names; several right rows give several rows."""
    return left.join(right, F.col(left_key) == F.col(right_key), "left")


def require_parents(
    units: DataFrame,
    parents: DataFrame,
    link: str,
    parent_key: str,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """Units whose parent exists. ``carry`` names parent columns to take along (old name
    to new name); the parent key must then be unique."""
    if not carry:
        keys = parents.select(F.col(parent_key).alias("_parent"))
        return units.join(keys, F.col(link) == F.col("_parent"), "left_semi")
    taken = parents.select(
        F.col(parent_key).alias("_parent"), *[F.col(a).alias(b) for a, b in carry.items()]
    )
    return units.join(taken, F.col(link) == F.col("_parent"), "inner").drop("_parent")
