"""Days that are published as a whole.

A day consists of several tables (classified calls, directory, facts, exports). A run writes each of them to
a folder of its own version and then publishes the day by one row in the manifest, which names the
version's folders. The row is one small file that Spark's commit moves into place, so a reader sees either all
tables of the old version or all of the new one, wherever a run fails; a version without a row does not exist.

    <path>/data/<table>/jour=<day>/version=<version>/   rows
    <path>/manifest/                                    one file for each publication

Several publications of a day are told apart by ``sequence``; runs that publish a day at the same
time get the same sequence, and the greater version name counts for everybody.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

ENTRY = "jour string, sequence bigint, version string, tables map<string, struct<folder: string, schema: string>>"


class UnknownDayError(LookupError):
    """The day, or a table of it, was never published."""


def _label(day: datetime.date | str) -> str:
    return day if isinstance(day, str) else day.isoformat()


class DayStore:
    """Published days of several tables below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        """All publications, also those that later ones have replaced."""
        try:
            return self.spark.read.schema(ENTRY).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def _current(self, days: Iterable[datetime.date | str] | None = None, keep: int = 1) -> list:
        """The last ``keep`` entries of each day, in order of days; one row for each day at most."""
        entries = self.entries()
        if days is not None:
            entries = entries.where(F.col("jour").isin([_label(d) for d in days]))
        every = F.collect_list(F.struct("sequence", "version", F.map_entries("tables").alias("tables")))
        last = F.slice(F.sort_array(every, asc=False), 1, keep)
        return entries.groupBy("jour").agg(last.alias("entries")).orderBy("jour").collect()

    def days(self) -> list[str]:
        return [r.jour for r in self._current()]

    def tables(self, day: datetime.date | str) -> dict[str, tuple[str, str]]:
        """Folder and schema (as JSON; empty for files that are not ORC) of each table of a published day."""
        found = self._current([day])
        if not found:
            raise UnknownDayError(f"{_label(day)} was never published in {self.path}")
        return {t["key"]: (t["value"]["folder"], t["value"]["schema"]) for t in found[0].entries[0].tables}

    def folder(self, table: str, day: datetime.date | str) -> str:
        """Where the published files of a table are, for exports."""
        tables = self.tables(day)
        if table not in tables:
            raise UnknownDayError(f"{_label(day)} has no {table} in {self.path}")
        return f"{self.path}/{tables[table][0]}"

    def read(self, table: str, days: Iterable[datetime.date | str] | None = None) -> DataFrame:
        """Rows of the given days, or of all, with the day as text in ``jour``. Columns are those of the last
        day; a day that was published without one of them has nulls there."""
        folders, schema = [], None
        for day in self._current(days):
            for t in day.entries[0].tables:
                if t["key"] == table:
                    folders.append(f"{self.path}/{t['value']['folder']}")
                    schema = t["value"]["schema"]
        if not folders:
            raise UnknownDayError(f"no published day has {table} in {self.path}")
        declared = StructType.fromJson(json.loads(schema))
        reader = self.spark.read.schema(StructType([*declared.fields]).add("jour", StringType()))
        rows = reader.option("basePath", f"{self.path}/data/{table}").orc(folders)
        return rows.select(*[f"`{n}`" for n in declared.names], "jour")

    def read_day(self, table: str, day: datetime.date | str) -> DataFrame:
        """One published day, without the column of the day."""
        return self.read(table, [day]).drop("jour")

    def draft(self, day: datetime.date | str) -> Draft:
        return Draft(self, _label(day))

    def vacuum(self, keep: int = 1, drafts: bool = False) -> list[str]:
        """Delete versions that the last ``keep`` publications of their day do not name. Versions that were
        never published go only with ``drafts``, for times when no run is under way. The deleted folders."""
        named = {t["value"]["folder"] for day in self._current(keep=keep) for e in day.entries for t in e.tables}
        published = {r.version for r in self.entries().select("version").collect()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/*/*/*")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for status in files.globStatus(path) or []:
            parts = status.getPath().toString().split("/")[-4:]
            version = parts[-1].removeprefix("version=")
            if "/".join(parts) not in named and (version in published or drafts):
                files.delete(status.getPath(), True)
                gone.append("/".join(parts))
        return sorted(gone)


class Draft:
    """A version of one day under way. Nobody reads it before ``publish``."""

    def __init__(self, store: DayStore, label: str):
        self.store, self.label = store, label
        self.version = uuid.uuid4().hex
        self.named: dict[str, tuple[str, str]] = {}
        self._begun: list[str] = []

    def _folder(self, table: str) -> str:
        folder = f"data/{table}/jour={self.label}/version={self.version}"
        self._begun.append(folder)
        return folder

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write the rows of a table and return them read back."""
        folder = self._folder(table)
        path = f"{self.store.path}/{folder}"
        df.write.orc(path)
        self.named[table] = (folder, df.schema.json())
        return self.store.spark.read.schema(df.schema).orc(path)

    def export(self, table: str, write: Callable[[str], None]) -> None:
        """Files of another format: ``write`` gets the folder for them."""
        folder = self._folder(table)
        write(f"{self.store.path}/{folder}")
        self.named[table] = (folder, "")

    def keep(self, table: str) -> DataFrame:
        """Take a table over from the published version, and read it."""
        self.named[table] = self.store.tables(self.label)[table]
        return self.store.read_day(table, self.label)

    def publish(self) -> None:
        """Make this version the day, in one step."""
        spark = self.store.spark
        last = self.store.entries().agg(F.max("sequence")).first()[0] or 0
        row = (self.label, last + 1, self.version, self.named)
        spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("append").parquet(f"{self.store.path}/manifest")

    def discard(self) -> None:
        """Delete what was written, after a failure."""
        for folder in self._begun:
            path = self.store.spark._jvm.org.apache.hadoop.fs.Path(f"{self.store.path}/{folder}")
            path.getFileSystem(self.store.spark._jsc.hadoopConfiguration()).delete(path, True)
