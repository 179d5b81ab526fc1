"""Regression check of two exported results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callweave.operators import changed_rows, diff_summary
from callweave.sources import read_csv


def regression_check(
    spark: SparkSession, expected_path: str, actual_path: str, sep: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """Counts, and the rows that only one of two CSV results has."""
    expected, actual = read_csv(spark, expected_path, sep=sep), read_csv(spark, actual_path, sep=sep)
    return diff_summary(expected, actual), changed_rows(expected, actual)
