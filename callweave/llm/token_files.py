"""Token ids in binary files, with document boundaries in Elias-Fano form.

A shard file holds the ids of its documents one after another, then the boundaries and the
document ids, each as an Elias-Fano sequence, then a footer of fixed size:

    magic (8) | ids, 2 or 4 bytes each | boundaries | document ids | footer (8 x 8) | magic (8)

Elias-Fano keeps n increasing numbers below u in about n (2 + log2(u / n)) bits: the lower bits
as they are, the upper ones in unary in a bit vector. Every 256th one of that vector has its
position stored, so a number is found by counting ones from there: no table of 64-bit offsets.

Documents are range-partitioned by id before they are encoded, so that shards in order hold
ids in order, and each task streams its shards to the shared folder. A shard's name has a
random part and the list of shards is what Spark committed, so files of lost or repeated
attempts are never read.

Null ids come first, then ascending ids; rows of the same id are ordered by their text. Null and
empty texts are the end id alone. An empty table has no shards and reads back empty.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from callweave.llm.common import one_array, slices, stages, text_column
from callweave.llm.tokens import Encoder

MAGIC = b"CWTOKEN1"
FOOTER = "<8q"
SAMPLE = 256
#: Documents whose boundaries a reader selects at a time.
READ_DOCS = 4096
#: Tokens after which a task begins a new shard; a document is never cut.
SHARD_TOKENS = 16 << 20
#: Bytes of text that a writing task encodes at a time, less than elsewhere since it also holds a shard's list.
WRITE_BYTES = 3 << 19
#: Text for one task.
TASK_BYTES = 64 << 20


def ef_encode(values: np.ndarray, universe: int) -> bytes:
    """Increasing numbers from 0 to ``universe``: header, lower bits, upper bits, samples."""
    n = len(values)
    low = max(int(np.log2(universe / n)), 0) if n and universe > n else 0
    upper = (values >> low) + np.arange(n)
    size = int(upper[-1]) + 1 if n else 0
    ones = np.zeros(size, np.uint8)
    ones[upper] = 1
    lower = (values[:, None] >> np.arange(low)) & 1 if low else np.zeros((n, 0), np.int64)
    lower_bytes = np.packbits(lower.astype(np.uint8).ravel(), bitorder="little").tobytes()
    upper_bytes = np.packbits(ones, bitorder="little").tobytes()
    samples = upper[::SAMPLE].astype("<u4").tobytes()
    return struct.pack("<4q", n, low, len(lower_bytes), len(upper_bytes)) + lower_bytes + upper_bytes + samples


class EliasFano:
    """Reads the numbers of an encoded sequence: one by ``select``, or all at once."""

    def __init__(self, data: memoryview):
        self.n, self.low, a, b = struct.unpack_from("<4q", data)
        at = 32
        self.lower = np.frombuffer(data, np.uint8, a, at)
        self.upper = np.frombuffer(data, np.uint8, b, at + a)
        self.samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at + a + b)

    def select(self, i: int) -> int:
        """The i-th number: the position of the i-th one, counted from the sample before it."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at >> 3
        bits = int(self.upper[byte]) >> (at & 7) << (at & 7)
        while (count := bits.bit_count()) <= left:
            left -= count
            byte += 1
            bits = int(self.upper[byte])
        for _ in range(left):
            bits &= bits - 1
        high = byte * 8 + (bits & -bits).bit_length() - 1 - i
        begin = i * self.low
        raw = int.from_bytes(self.lower[begin >> 3 : (begin + self.low + 7) >> 3].tobytes(), "little")
        return high << self.low | (raw >> (begin & 7)) & ((1 << self.low) - 1)

    def run(self, a: int, b: int) -> np.ndarray:
        """The numbers from the a-th to before the b-th, by one select for all: bits are read from the sample
        before the first to the one after the last, and no number outside is decoded."""
        if a >= b:
            return np.zeros(0, np.int64)
        first, after = a // SAMPLE, (b - 1) // SAMPLE + 1
        begin = int(self.samples[first])
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.upper)
        bits = np.unpackbits(self.upper[begin >> 3 : (end + 7) >> 3], bitorder="little")
        bits[: begin & 7] = 0
        ones = np.flatnonzero(bits)[a - first * SAMPLE : b - first * SAMPLE] + (begin & ~7)
        values = (ones - np.arange(a, b)) << self.low
        if self.low:
            at = a * self.low
            bits = np.unpackbits(self.lower[at >> 3 : (b * self.low + 7) >> 3], bitorder="little")
            bits = bits[at & 7 :][: (b - a) * self.low].reshape(b - a, self.low)
            values |= bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low))
        return values


class Shard:
    """One shard file while it is written."""

    def __init__(self, folder: str, name: str, width: int):
        self.files, self.path = fs.FileSystem.from_uri(f"{folder}/{name}")
        self.files.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.files.open_output_stream(self.path)
        self.out.write(MAGIC)
        self.width, self.ends, self.ids, self.n_tokens = width, [], [], 0

    def add(self, tokens: np.ndarray, ends: np.ndarray, ids: list) -> None:
        self.out.write(tokens.astype(f"<u{self.width}").tobytes())
        self.ends.append(ends + self.n_tokens)
        self.ids += ids
        self.n_tokens += len(tokens)

    def close(self) -> None:
        ends = np.concatenate([np.zeros(1, np.int64), *self.ends])
        known = [i for i in self.ids if i is not None]
        base = known[0] if known else 0
        boundaries = ef_encode(ends, self.n_tokens)
        offsets = np.array([i - base for i in known], dtype=np.int64)
        names = ef_encode(offsets, int(offsets[-1]) if known else 0)
        self.out.write(boundaries + names)
        self.out.write(struct.pack(FOOTER, len(self.ids), self.n_tokens, self.width, len(boundaries), len(names),
                                   len(self.ids) - len(known), base, 0) + MAGIC)
        self.out.close()


class ShardReader:
    """The parts of a shard's content."""

    def __init__(self, content: bytes):
        data = memoryview(content)
        if bytes(data[:8]) != MAGIC or bytes(data[-8:]) != MAGIC:
            raise ValueError("not a whole shard file")
        self.n, self.n_tokens, self.width, a, b, self.n_null, self.base, _ = struct.unpack_from(FOOTER, data, len(data) - 72)
        at = 8 + self.n_tokens * self.width
        self.tokens = np.frombuffer(data, f"<u{self.width}", self.n_tokens, 8)
        self.boundaries = EliasFano(data[at : at + a])
        self.names = EliasFano(data[at + a : at + a + b])

    def ids(self, a: int, b: int) -> list:
        """Ids of the documents a to b - 1; those without one come first."""
        known = self.names.run(max(a - self.n_null, 0), max(b - self.n_null, 0))
        return [None] * (b - a - len(known)) + (known + self.base).tolist()

    def document(self, i: int) -> np.ndarray:
        """Tokens of the i-th document, from two selects."""
        return self.tokens[self.boundaries.select(i) : self.boundaries.select(i + 1)]


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 0) -> None:
    """Write shards below ``folder``/shards and their list, a Parquet table with the tokens and
    documents before each shard, to ``folder``/list. ``folder`` is one that all executors share."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_column(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    home = re.sub("^file:/+", "/", f"{folder}/shards")  # a plain path is one for pyarrow, too

    def write(batches):
        encoder, part, shard, done = Encoder.of_worker(tokenizer_file), TaskContext.get().partitionId(), None, []
        width = 2 if encoder.library.get_vocab_size() <= 1 << 16 else 4
        for batch in slices(batches, limit=WRITE_BYTES):
            if shard is None:
                name = f"{part:08d}-{len(done):06d}-{uuid.uuid4().hex}.tokens"
                shard = Shard(home, name, width)
            ids, at = encoder.encode(batch.column("text"))
            ids = np.insert(ids, at[1:], end_id)
            shard.add(ids, at[1:] + np.arange(1, len(at)), one_array(batch.column("doc_id")).to_pylist())
            if shard.n_tokens >= SHARD_TOKENS:
                shard.close()
                done.append((part, len(done), name, len(shard.ids), shard.n_tokens))
                shard = None
        if shard is not None:
            shard.close()
            done.append((part, len(done), name, len(shard.ids), shard.n_tokens))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "seq", "file", "n_docs", "n_tokens"],
            )

    shards = (
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(write, "part int, seq int, file string, n_docs long, n_tokens long")
    )
    shards.write.parquet(f"{folder}/attempts")  # commits one attempt of each task
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    (
        spark.read.parquet(f"{folder}/attempts")
        .withColumn("tokens_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
        .withColumn("docs_before", F.coalesce(F.sum("n_docs").over(before), F.lit(0)))
        .write.parquet(f"{folder}/list")
    )


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document of the shards: position (its rank), doc_id, start, n_tokens, ids_crc32 and,
    if asked for, its ids."""
    listed = spark.read.parquet(f"{folder}/list").select("file", "tokens_before", "docs_before")
    files = (
        spark.read.format("binaryFile").load(f"{folder}/shards/*.tokens")
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
        if listed.limit(1).count() else spark.createDataFrame([], "file string, content binary")
    )
    kinds = "position long, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = ShardReader(batch.column("content")[i].as_buffer())
                for a in range(0, shard.n, READ_DOCS):
                    b = min(a + READ_DOCS, shard.n)
                    at = shard.boundaries.run(a, b + 1)
                    tokens = shard.tokens[at[0] : at[-1]].astype("<u4")
                    view, cuts = memoryview(tokens).cast("B"), (at - at[0]).tolist()
                    crc = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(cuts, cuts[1:])]
                    arrays = [
                        pa.array(np.arange(a, b) + batch.column("docs_before")[i].as_py()),
                        pa.array(shard.ids(a, b), pa.int64()),
                        pa.array(at[:-1] + batch.column("tokens_before")[i].as_py()),
                        pa.array(np.diff(at)), pa.array(crc, pa.int64()),
                    ]
                    if with_ids:
                        arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(tokens.view("<i4"))))
                    yield pa.RecordBatch.from_arrays(
                        arrays, names=["position", "doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
                    )

    return files.join(listed, "file").mapInArrow(documents, kinds)


def token_folder(spark: SparkSession) -> str:
    return stages(spark).folder
