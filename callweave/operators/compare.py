"""Comparing data sets.

All comparisons are set comparisons (duplicates do not count, null equals null). Both
sides are stacked and grouped by their values, so one shuffle answers both directions
and copies of a row collapse before it.

Columns are matched by name, or by place if the sides have as many columns under other
names (``schema_differences`` lists them). Different types are an error: nothing is cast to
make values look alike; ``normalize_for_diff`` is there for that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from callweave.functions.dates import iso_text

LEFT_ONLY, RIGHT_ONLY = "left", "right"


class ColumnCountError(ValueError):
    """The two data sets do not have the same number of columns."""


class ColumnTypeError(ValueError):
    """Columns of the two data sets that stand for the same thing have different types."""


def schema_differences(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """Names that only one side has and names whose types differ, as (name, left type, right
    type), with None for a side without the name."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    return [(n, a.get(n), b.get(n)) for n in dict.fromkeys([*a, *b]) if a.get(n) != b.get(n)]


def columns_only_left(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c not in set(right.columns)]


def _counted(left: DataFrame, right: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Distinct rows with the number of times each side has them."""
    if len(left.columns) != len(right.columns):
        raise ColumnCountError(
            f"{len(left.columns)} columns against {len(right.columns)}; "
            f"only left: {columns_only_left(left, right)}, "
            f"only right: {columns_only_left(right, left)}"
        )
    if set(left.columns) != set(right.columns):  # other names: columns are compared by place
        right = right.toDF(*left.columns)
    types = [d for d in schema_differences(left, right) if d[0] not in set(drop)]
    if types:
        raise ColumnTypeError("; ".join(f"{n}: {a} against {b}" for n, a, b in types))
    names = [c for c in left.columns if c not in set(drop)]
    quoted = [f"`{c}`" for c in names]
    both = left.select(*quoted, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*quoted, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return both.groupBy(*quoted).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def _side() -> Column:
    return F.when(F.col("_r") == 0, LEFT_ONLY).when(F.col("_l") == 0, RIGHT_ONLY)


def changed_rows(left: DataFrame, right: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Distinct rows that only one side has, with the side in ``side``."""
    counted = _counted(left, right, drop)
    return (
        counted.withColumn("side", _side()).where(F.col("side").isNotNull()).drop("_l", "_r")
    )


def diff_summary(left: DataFrame, right: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """One row: rows of each side, and distinct rows that only one side has."""
    counted = _counted(left, right, drop)
    return counted.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("right_rows"),
        F.count_if(F.col("_r") == 0).alias("left_only"),
        F.count_if(F.col("_l") == 0).alias("right_only"),
    )


def diff_by_column(
    left: DataFrame, right: DataFrame, id_column: str, drop: Sequence[str] = ()
) -> DataFrame:
    """Per column, the (id, value) pairs that only one side has.

    Result columns: ``column``, the id column, ``value`` (as text) and ``side``. Only ids
    with a changed row can have such a pair, so only their rows are unfolded.
    """
    counted = _counted(left, right, drop)
    others = [c for c in left.columns if c not in set(drop) and c != id_column]
    changed = counted.where((F.col("_l") == 0) | (F.col("_r") == 0))
    ids = changed.select(F.col(f"`{id_column}`").alias("_id"))
    rows = counted.join(ids, F.col(f"`{id_column}`").eqNullSafe(F.col("_id")), "left_semi")
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                for c in others
            ]
        )
    )
    pairs = rows.select(f"`{id_column}`", "_l", "_r", cells.alias("_cell")).select(
        "_cell.column", f"`{id_column}`", "_cell.value", "_l", "_r"
    )
    sides = pairs.groupBy("column", f"`{id_column}`", "value").agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r")
    )
    return sides.withColumn("side", _side()).where(F.col("side").isNotNull()).drop("_l", "_r")


def normalize_for_diff(
    df: DataFrame,
    to_double: Sequence[str] = (),
    to_iso: Sequence[str] = (),
    from_iso: Sequence[str] = (),
    to_minute: Sequence[str] = (),
    strip_quotes: Sequence[str] = (),
    trim: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    where: Column | str | None = None,
) -> DataFrame:
    """Bring two exports of the same facts into the same form before comparing them:
    numbers as double, ``T`` or blank in timestamps, no ``.000``, minutes only, no quotes,
    no outer blanks, other names, columns left out, and optionally some rows only."""
    changes: dict[str, Column] = {}
    changes.update({c: F.col(c).try_cast("double") for c in to_double})
    changes.update({c: iso_text(F.col(c)) for c in to_iso})
    changes.update({c: F.regexp_replace(F.col(c), "T", " ") for c in from_iso})
    changes.update(
        {c: F.date_format(F.col(c).try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm") for c in to_minute}
    )
    changes.update({c: F.regexp_replace(F.col(c), '"', "") for c in strip_quotes})
    changes.update({c: F.trim(F.col(c)) for c in trim})
    result = df if where is None else df.where(where)
    result = result.withColumns(changes) if changes else result
    return result.withColumnsRenamed(dict(rename or {})).drop(*drop)


def fingerprint(df: DataFrame, method: str = "xxhash64") -> DataFrame:
    """Order-insensitive fingerprint of a table: number of rows, sum and exclusive-or of
    the row hashes. ``method="md5"`` hashes the values as text, which other engines can
    repeat; ``"xxhash64"`` is faster. Both tell a null from any text and see a value move from
    one column to the next: the first writes the length of each text before it, the second
    hashes which values are null, too."""
    names = [f"`{c}`" for c in df.columns]
    if method == "xxhash64":
        row_hash = F.xxhash64(*[F.isnull(n) for n in names], *names)
    else:
        texts = [F.col(n).cast("string") for n in names]
        values = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
        digest = F.md5(F.concat_ws(",", *values).cast("binary"))
        row_hash = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    hashed = df.select(row_hash.alias("_hash"))
    return hashed.agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("_hash").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("_hash").alias("hash_xor"),
    )
