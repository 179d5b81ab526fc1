"""Predicates with a decided answer for null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_true(condition: Column) -> Column:
    """The condition, with null read as false."""
    return F.coalesce(condition, F.lit(False))


def is_blank(column: Column) -> Column:
    """Null or empty text."""
    return F.coalesce(column, F.lit("")) == ""


def is_eight_digits_from_one(column: Column) -> Column:
    """Eight characters long and starting with 1; false for null."""
    return is_true((F.length(column) == 8) & column.startswith("1"))
