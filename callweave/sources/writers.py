"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from callweave.operators.rows import distinct_in_ranges


def write_orc_table(df: DataFrame, table: str) -> None:
    """Managed ORC table, replaced as a whole."""
    df.write.mode("overwrite").format("orc").saveAsTable(table)


def write_orc(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").orc(path)


def write_days(df: DataFrame, path: str, day: str = "jour", by: Sequence[str] = ()) -> None:
    """ORC folder partitioned by day. Only the days that occur in ``df`` are replaced, so
    running one day again leaves the others alone. ``by`` clusters the rows inside a day."""
    if by:
        df = df.sortWithinPartitions(*by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).orc(path)


def write_day(df: DataFrame, path: str, label: str, day: str = "jour") -> None:
    """One day of a folder partitioned by day. Its partition is replaced even if the new
    result is empty; the other days are left alone."""
    df.drop(day).write.mode("overwrite").orc(f"{path}/{day}={label}")


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep).csv(path)


def export_sorted_csv(
    df: DataFrame, path: str, sep: str = ";", single_file: bool = False
) -> None:
    """Distinct rows in total order as CSV with header.

    One shuffle by ranges of all columns serves both: equal rows meet in one task, which drops copies and sorts,
    and the part files in name order are the sorted result.
    ``single_file`` sorts in one task and writes one file: for results that a spreadsheet can take.
    """
    if single_file:
        columns = [f"`{c}`" for c in df.columns]
        write_csv(df.distinct().repartition(1).sortWithinPartitions(*columns), path, sep)
    else:
        write_csv(distinct_in_ranges(df), path, sep)
