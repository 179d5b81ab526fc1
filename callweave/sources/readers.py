"""Reading the daily files and the reference files."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from callweave import fixed_values as fv
from callweave.operators.contract import require_columns


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
    escape: str = "\\",
) -> DataFrame:
    """CSV with a given schema, or with the names of its header and all text. Types are
    never inferred, so the files are read once. A file whose header has other names or
    another order fails the query with its name; ``read_csv_by_header`` takes such files."""
    reader = spark.read.options(header=header, sep=sep, quote=quote, escape=escape)
    if header:
        reader = reader.option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_by_header(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ","
) -> DataFrame:
    """Declared columns of CSV files that need not have them in the same order.

    Each file's own header says where its columns are. One pass over the first lines of all files finds
    the headers; files with equal headers are one scan, so the number of jobs follows the
    number of different headers, not of files.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    by_header = files_by_header(spark, path)
    if not by_header:
        return spark.createDataFrame([], declared)
    parts = [read_csv_columns(spark, files, declared, sep) for files in by_header.values()]
    return reduce(DataFrame.unionByName, parts)


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files of each first line that is not blank, in one job. What comes to the driver are the names of the files
    (which it has listed anyway) and the different headers. Files without a line are left out."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    # A header stands at the start of the file's first block; of that only the first line is kept by each task.
    first = lines.where((F.col("place.file_block_start") == 0) & (F.trim("value") != ""))
    headers = first.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    # Names come as parts of a URI, and reads take them as they are.
    return {r.header: [unquote(f) for f in r.files] for r in found.collect()}


def read_csv_columns(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ","
) -> DataFrame:
    """CSV of many columns, of which only the declared ones are kept, in declared order
    and type. Columns are found by header name, which must be the same in all files; only
    those are parsed."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = require_columns(read_csv(spark, path, sep=sep), declared.names, str(path))
    return wide.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in declared.fields]
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files or folders of fixed-width lines, one text column ``value``. The whole line is
    kept, also behind a comma."""
    return spark.read.text(path)


def read_layout_file(spark: SparkSession, path: str) -> DataFrame:
    """Layout of a fixed-width file: ``nom, long, a, De_officiel, de``."""
    return read_csv(spark, path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_tickets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv_columns(spark, path, fv.TICKET_DDL)


def read_ivr_calls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, fv.IVR_CALL_DDL)


def read_ivr_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, fv.IVR_BLOCK_DDL)
