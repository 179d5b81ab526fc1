"""Column contracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class ColumnContractError(ValueError):
    """A required column is missing or has another type."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required names that the DataFrame does not have, in the order asked for."""
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """The DataFrame itself, or an error that names the missing columns."""
    missing = missing_columns(df, required)
    if missing:
        raise ColumnContractError(f"{what}: missing columns {', '.join(missing)}")
    return df


def require_schema(df: DataFrame, schema: StructType | str, what: str = "output") -> DataFrame:
    """The declared columns in declared order, or an error on a missing name or other type."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    require_columns(df, declared.names, what)
    for field in declared.fields:
        found = df.schema[field.name].dataType
        if found != field.dataType:
            raise ColumnContractError(
                f"{what}: {field.name} is {found.simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return df.select(*[f"`{name}`" for name in declared.names])
