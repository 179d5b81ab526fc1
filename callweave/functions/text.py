"""Text helpers: trimming, fixed-width lines, positional flags, codes inside text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from callweave import fixed_values as fv


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every string column; other columns pass unchanged. A text of blanks
    only becomes the empty string, not null."""
    return df.select(
        *[
            F.trim(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


MAX_FIELDS = 10_000


def read_layout(layout: DataFrame) -> list[tuple[str, int, int]]:
    """Layout rows ``nom, de, long`` as (name, 1-based start, length), in start order.

    The layout describes columns, so it has as many rows as the result has columns
    and belongs on the driver; one of more than ``MAX_FIELDS`` rows is refused. Rows with a
    missing or unreadable value are left out.
    """
    fields = layout.select(
        F.trim("nom").alias("nom"),
        F.trim(F.col("de").cast("string")).try_cast("int").alias("de"),
        F.trim(F.col("long").cast("string")).try_cast("int").alias("long"),
    ).dropna()
    found = fields.orderBy("de", "nom").limit(MAX_FIELDS + 1).collect()
    if len(found) > MAX_FIELDS:
        raise ValueError(f"a layout of more than {MAX_FIELDS} fields")
    return [(r["nom"], max(r["de"], 1), r["long"]) for r in found]


def fixed_width(
    lines: DataFrame, layout: Sequence[tuple[str, int, int]], content: str = "value"
) -> DataFrame:
    """Cut one text column into named columns by position."""
    return lines.select(
        *[F.substring(F.col(content), start, length).alias(name) for name, start, length in layout]
    )


def decode_flags(
    df: DataFrame,
    column: str = "InternFacilities",
    positions: Mapping[str, int] = fv.FACILITY_POSITIONS,
) -> DataFrame:
    """One integer column per named position; null where the character is no digit."""
    return df.withColumns(
        {name: F.substring(F.col(column), at, 1).try_cast("int") for name, at in positions.items()}
    )


def typed_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add null columns that have a real type, so that every format can store them."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})


def office_code(column: Column) -> Column:
    """First office code in a block name; empty text when there is none."""
    return F.regexp_extract(column, fv.OFFICE_CODE_PATTERN, 1)


def sip_user(column: Column) -> Column:
    """User part of a SIP address, right-trimmed."""
    return F.rtrim(F.regexp_extract(column, fv.SIP_USER_PATTERN, 1))


def without_blanks(column: Column, length: int) -> Column:
    """First ``length`` characters after taking all blanks out."""
    return F.substring(F.regexp_replace(column, " ", ""), 1, length)
