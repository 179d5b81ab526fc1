"""Helpers shared by the operators: stage tables, bytes of Arrow columns, hashing of integers."""

from __future__ import annotations

import contextlib
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.sources.shared import Stages

#: Bytes of text that a task turns into arrays at a time; one longer text is its own slice.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


#: Where stage folders are noted while ``noted_stages`` is open.
_notes: list[list[Stages]] = []


def stages(spark: SparkSession) -> Stages:
    """Stage tables of one run, in a folder of their own below ``spark.checkpoint.dir``."""
    made = Stages(spark)
    for note in _notes:
        note.append(made)
    return made


@contextlib.contextmanager
def noted_stages():
    """A list of all stage folders made meanwhile, for a caller who knows when to remove them."""
    _notes.append([])
    try:
        yield _notes[-1]
    finally:
        _notes.pop()


def drop(kept: Stages, *names: str) -> None:
    """Delete stage tables that nothing reads any more."""
    for name in names:
        Stages(kept.spark, kept.path(name)).remove()


def text_column(name: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for objects dear to load."""
    home = sys.modules.setdefault("_callweave_worker", types.ModuleType("_callweave_worker"))
    return home.__dict__.setdefault("kept", {})


def clear_worker_cache() -> None:
    """Give back what an operator before has left in this Python worker: one pool of workers serves all stages."""
    kept = worker_cache()
    if kept:
        kept.clear()
        pa.default_memory_pool().release_unused()


def one_array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows in them (one more than rows)."""
    column = one_array(column).cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """Cut record batches into runs of rows with at most ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(at, at[begin] + limit, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over the whole range (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers of all ranges [start, start + count), one after another."""
    counts = counts.astype(np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(first - starts.astype(np.int64), counts)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def chosen_rows(kept: Stages, table: DataFrame, numbers: DataFrame, inside: bool) -> DataFrame:
    """``row`` of the stage table's rows whose ``number`` is among ``numbers``, or is not.

    Numbers are those of monotonically_increasing_id, so the upper bits name the task that wrote a
    row. The numbers are written with a folder for each such task, and whoever reads its
    rows reads that folder too: wide rows are filtered where they lie and never shuffled.
    """
    spark, path = table.sparkSession, kept.path("chosen")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_part = numbers.select("number", F.shiftright("number", 33).alias("part"))
    by_part.repartition(parts, "part").write.partitionBy("part").parquet(path)
    home = re.sub("^file:/+", "/", path)  # a plain path is one for pyarrow, too

    def pick(batches):
        part, known = None, None
        for batch in batches:
            number = batch.column("number")
            mask = np.zeros(batch.num_rows, bool)
            tasks = number.to_numpy() >> 33
            for task in np.unique(tasks).tolist():
                if task != part:
                    part, known = task, _numbers(f"{home}/part={task}")
                own = tasks == task
                mask[own] = pc.is_in(number, value_set=known).to_numpy(zero_copy_only=False)[own] == inside
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(mask))], names=["row"])

    return table.select("row", "number").mapInArrow(pick, f"row {table.schema['row'].dataType.simpleString()}")


def parquet_files(folder: str) -> tuple[fs.FileSystem, list[str]]:
    """The Parquet files of one part of a folder that Spark wrote by parts. A part that has no rows has no folder; if
    the folder of all parts is not there, the task looks in another place than Spark wrote to, or it was
    removed, and the job fails: taken for an empty part it would silently lose rows."""
    files, root = fs.FileSystem.from_uri(folder)
    if files.get_file_info(root).type == fs.FileType.Directory:
        return files, [i.path for i in files.get_file_info(fs.FileSelector(root)) if i.path.endswith(".parquet")]
    whole = root.rsplit("/", 1)[0]
    if files.get_file_info(whole).type != fs.FileType.Directory:
        raise FileNotFoundError(f"{whole} is not there, so its part {folder} cannot be known to be empty")
    return files, []


def _numbers(folder: str) -> pa.Array:
    files, names = parquet_files(folder)
    found = []
    for name in names:
        with files.open_input_file(name) as file:
            found.append(one_array(pq.ParquetFile(file).read(columns=["number"])["number"]))
    return pa.concat_arrays(found) if found else pa.array([], pa.int64())
