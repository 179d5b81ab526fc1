"""Rows that do not fit their schema, kept apart with their file and line.

A CSV reader that turns a bad number into null leaves no trace of it. Here a line with a value of
another type, or with too few or too many values, goes whole to the quarantine: a Parquet folder
with the file and the line as it was. The rest of the file is read as usual. More bad lines than
a limit end the read with the names of the files that have most of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from callweave.operators.contract import require_columns
from callweave.sources.shared import Stages

LINE, FILE = "_bad_line", "_bad_file"
#: Files that an error names, at most.
NAMED_FILES = 10


class BadRowsError(ValueError):
    """More lines than allowed do not fit the schema."""


def read_csv_quarantined(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    quarantine: str,
    stages: Stages,
    limit: int = 0,
    name: str = "checked",
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    columns_only: bool = False,
) -> DataFrame:
    """Good rows of CSV files with a header, in the declared columns and types; bad lines are written to the folder
    ``quarantine`` (replaced) as ``file`` and ``line``. More than ``limit`` of them raise ``BadRowsError``; they
    are in the quarantine then, too.

    ``columns_only`` finds the declared columns among others by the header, which has to be the same in
    all files; the others are text. Empty values are null, not bad. The files are parsed once, all declared
    columns together, and kept as the stage ``name``: a later read of few columns could not tell bad lines.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.options(header=True, sep=sep, quote=quote, escape=escape)
    wide = declared
    if columns_only:
        names = require_columns(reader.csv(path), declared.names, str(path)).columns
        known = {f.name: f.dataType for f in declared.fields}
        wide = StructType()
        for column in names:
            wide = wide.add(column, known.get(column, StringType()))
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, enforceSchema=False, columnPruning=False)
    lines = reader.schema(StructType([*wide.fields]).add(LINE, StringType())).csv(path)
    own = [f"`{n}`" for n in declared.names]
    parsed = stages.keep(lines.select(*own, LINE, F.col("_metadata.file_path").alias(FILE)), name)
    bad = parsed.where(F.col(LINE).isNotNull()).select(F.col(FILE).alias("file"), F.col(LINE).alias("line"))
    bad.write.mode("overwrite").parquet(quarantine)
    counts = spark.read.schema("file string, line string").parquet(quarantine).groupBy("file").agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total > limit:
        worst = counts.orderBy(F.desc("n"), "file").limit(NAMED_FILES).collect()
        named = ", ".join(f"{r.file}: {r.n}" for r in worst)
        raise BadRowsError(f"{total} bad lines, at most {limit} allowed; see {quarantine} ({named})")
    return parsed.where(F.col(LINE).isNull()).select(*own)
