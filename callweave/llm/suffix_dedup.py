"""Removal of byte passages that a document with a smaller id has, too, by sorting suffixes.

A byte goes if some ``LENGTH``-byte string over it also starts in a document with a smaller id.

Suffixes: of the k-grams in each LENGTH-byte window the one with the least hash is its anchor, the
leftmost of equal ones. Equal windows have equal anchors at the same place, so it is enough to
sort the suffixes at anchors, one of 14 on average, each with the bytes that its windows reach.
An anchor's windows stand side by side: it and they are one record.

1. Documents are written in blocks of some megabytes.
2. Anchors are hashed, distinct by block, and compared by hash; a record goes on only if its anchor
   stands in two documents. This drops most records and loses none that could be equal.
3. Splitters, from a sample of bounded size, cut the sorted order of suffixes into buckets. They
   are whole anchors, so suffixes that can share a window meet in one bucket. A bucket sorts its
   suffixes by multikey sort (8 bytes at a time, ties only), so equal anchors are neighbours.
   Where their records are the same, the least id holds for all windows; else the
   windows are compared one by one. Each block learns the least id of its windows.
4. Blocks mark the windows with a smaller id and cut out the bytes that these cover.

A record goes out once for each block, however often the block has it, so what one passage adds
to a bucket is bounded by the number of blocks. Answers to blocks are tables with a folder for
each writing task of step 1; the task that works on its blocks reads them from there, and
texts are never shuffled.

Null and empty texts, and those shorter than LENGTH, lose nothing. Documents with a null id neither
lose nor take anything. Rows of the same id take nothing from each other.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from callweave.llm.common import drop, mixed, one_array, parquet_files, ranges, slices, stages, text_column, utf8

LENGTH, GRAM = 50, 24
WINDOWS = LENGTH - GRAM + 1
WIDTH = LENGTH + WINDOWS - 1  # longest content of a record
BLOCK_BYTES = 2 << 20
#: Bytes of text, and rows of bytes, that become arrays at a time.
RUN_BYTES, ROWS = 1 << 19, 8192
#: Records that a bucket aims at, and sampled suffixes for each bucket (at most SAMPLES in all).
BUCKET_RECORDS, SAMPLES = 80_000, 50_000
#: Blocks that are sampled for the splitters, at most twice as many.
SAMPLED_BLOCKS = 64
#: Windows that are compared at a time.
CHUNK = 50_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number whose order is that of the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step, shift in ((1, 8), (2, 16), (4, 32)):
        padded = (padded[:-step] << np.uint64(shift)) | padded[step:]
    return padded[: len(data)]


def records(data: np.ndarray, at: np.ndarray, known: np.ndarray):
    """Records of the texts whose id is known: hash of the anchor, first window, number of windows,
    anchor's distance from the first window, and the text."""
    parts, begin = [], 0
    while begin < len(at) - 1:  # a run of texts at a time, so that arrays stay small
        end = max(int(np.searchsorted(at, at[begin] + RUN_BYTES, side="right")) - 1, begin + 1)
        found = _records(data[at[begin] : at[end]], at[begin : end + 1] - at[begin], known[begin:end])
        if found:
            hashes, first, count, lead, text = found
            parts.append((hashes, first + at[begin], count, lead, text + begin))
        begin = end
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    return tuple(np.concatenate(c) for c in zip(*parts))


def _records(data: np.ndarray, at: np.ndarray, known: np.ndarray):
    n, m = len(data) - LENGTH + 1, len(data) - GRAM + 1
    if n <= 0:
        return None
    word = _words(data)
    hashes = word[:m] * _A
    hashes += word[8 : m + 8] * _B
    hashes += word[16 : m + 16] * _C
    hashes = mixed(hashes)
    # Least upper half of the hash; the place below it makes the leftmost of equal ones the least.
    best, span = hashes & np.uint64(0xFFFFFFFF00000000) | np.arange(m, dtype=np.uint64), 1
    while span < WINDOWS:
        step = min(span, WINDOWS - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    last = np.repeat(np.where(known, at[1:], 0), np.diff(at))[:n]
    valid = np.flatnonzero(last - np.arange(n) >= LENGTH)
    if not len(valid):
        return None
    anchor = (best[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)])
    first, count = valid[new], np.diff(np.r_[new, len(valid)])
    return hashes[anchor[new]], first, count, anchor[new] - first, np.searchsorted(at, first, side="right") - 1


def content(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Bytes of the records' windows as rows, zero beyond their end, padded to whole words."""
    out = np.zeros((len(first), -(-WIDTH // 8) * 8), np.uint8)
    for i in range(0, len(first), ROWS):
        size = count[i : i + ROWS] + LENGTH - 1
        out[np.repeat(np.arange(i, i + len(size)), size), ranges(np.zeros(len(size)), size)] = data[ranges(first[i : i + ROWS], size)]
    return out


def _cut_out(rows: np.ndarray, record: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """``length`` bytes of the given rows from ``start`` on."""
    out = np.zeros((len(record), length), np.uint8)
    for i in range(0, len(record), ROWS):
        out[i : i + ROWS] = rows[record[i : i + ROWS, None], start[i : i + ROWS, None] + np.arange(length)]
    return out


def _digest(rows: np.ndarray, seed: int) -> np.ndarray:
    words = np.ascontiguousarray(rows).view("<u8").reshape(len(rows), rows.shape[1] // 8)
    total = np.full(len(rows), seed, np.uint64)
    for i in range(words.shape[1]):
        total = mixed(total ^ words[:, i]) + _B
    return total


def distinct_records(data, at, doc_ids, known, wanted: np.ndarray):
    """Distinct records of a block whose anchors are wanted (sorted hashes): content, number of
    windows, anchor's distance, least and largest id; and for each record of the block its
    number among them, first window and id. The order depends on the block alone."""
    hashes, first, count, lead, text = records(data, at, known)
    spot = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
    keep = np.flatnonzero(wanted[spot] == hashes) if len(wanted) else np.zeros(0, np.int64)
    first, count, lead, ids = first[keep], count[keep], lead[keep], doc_ids[text[keep]]
    rows = content(data, first, count)
    shape = (count * 64 + lead).astype(np.uint64)
    one, two = _digest(rows, 1) ^ mixed(shape), _digest(rows, 2) ^ shape
    order = np.lexsort((ids, two, one))
    one, two = one[order], two[order]
    head = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])] if len(one) else np.zeros(0, bool)
    starts = np.flatnonzero(head)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(head) - 1
    pick = order[starts]
    least = ids[pick]
    largest = ids[order[np.r_[starts[1:], len(order)] - 1]] if len(order) else ids
    return (rows[pick], count[pick], lead[pick], least, largest), (number, first, ids)


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their words; each further word sorts only what is still tied."""
    order = np.argsort(words[0], kind="stable")
    tied = words[0][order]
    group = np.cumsum(np.r_[False, tied[1:] != tied[:-1]])
    for word in words[1:]:
        size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        open_ = np.flatnonzero(size[group] > 1) if len(group) else group
        if not len(open_):
            break
        part = order[open_]
        again = np.lexsort((word[part], group[open_]))
        order[open_] = part[again]
        value = word[order]
        group = np.cumsum(np.r_[False, (group[1:] != group[:-1]) | (value[1:] != value[:-1])])
    return order


def least_ids(rows, count, lead, least, largest):
    """Runs of windows that some smaller id than the record's largest has: record, first window in
    it, number of windows and that least id."""
    anchor = _cut_out(rows, np.arange(len(rows)), lead, GRAM)
    words = [anchor[:, i : i + 8].copy().view(">u8").ravel().astype(np.uint64) for i in range(0, GRAM, 8)]
    order = multikey_order(words)
    same = np.ones(max(len(order) - 1, 0), bool)
    for w in words:
        same &= w[order][1:] == w[order][:-1]
    starts = np.flatnonzero(np.r_[True, ~same])
    size = np.diff(np.r_[starts, len(order)])
    group = np.repeat(np.arange(len(starts)), size)
    low, high = np.minimum.reduceat(least[order], starts), np.maximum.reduceat(largest[order], starts)
    whole = _digest(rows, 3) ^ mixed((count * 64 + lead).astype(np.uint64))
    alike = np.minimum.reduceat(whole[order], starts) == np.maximum.reduceat(whole[order], starts)
    shared = low < high
    # Records that are all the same: one least id for all their windows.
    settled = order[(shared & alike)[group]]
    bound = low[group[(shared & alike)[group]]]
    hit = bound < largest[settled]
    out = [(settled[hit], np.zeros(hit.sum(), np.int64), count[settled[hit]], bound[hit])]
    # Others: their windows one by one, a few groups at a time.
    todo = order[(shared & ~alike)[group]]
    groups = group[(shared & ~alike)[group]]
    if len(todo):
        total = np.cumsum(count[todo])
        edge = np.r_[True, groups[1:] != groups[:-1]]
        cut = np.flatnonzero(edge)
        begin = 0
        while begin < len(todo):
            base = total[begin] - count[todo[begin]]
            later = cut[cut > begin]
            ahead = later[total[later - 1] - base <= CHUNK]
            end = int(ahead[-1]) if len(ahead) else (int(later[0]) if len(later) else len(todo))
            if len(later) == len(ahead) and total[-1] - base <= CHUNK:
                end = len(todo)
            out.append(_compared(todo[begin:end], rows, count, least, largest))
            begin = end
    return tuple(np.concatenate(c) for c in zip(*out))


def _compared(part, rows, count, least, largest):
    n = count[part]
    record = np.repeat(part, n)
    window = ranges(np.zeros(len(part)), n)
    text = np.zeros((len(record), -(-LENGTH // 8) * 8), np.uint8)
    text[:, :LENGTH] = _cut_out(rows, record, window, LENGTH)
    one, two = _digest(text, 4), _digest(text, 5)
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    low = np.empty(len(order), np.int64)
    low[order] = np.repeat(np.minimum.reduceat(least[record][order], starts), np.diff(np.r_[starts, len(order)]))
    hit = np.flatnonzero(low < largest[record])
    if not len(hit):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    record, window, low = record[hit], window[hit], low[hit]
    new = np.flatnonzero(np.r_[True, (record[1:] != record[:-1]) | (window[1:] != window[:-1] + 1) | (low[1:] != low[:-1])])
    return record[new], window[new], np.diff(np.r_[new, len(hit)]), low[new]


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed Arrow table."""
    sink = pa.BufferOutputStream()
    batch = pa.record_batch({k: pa.array(v) for k, v in arrays.items()})
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def write_blocks(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Write ``doc_id`` and ``text`` as files of blocks, one file for each task, and give the table
    of the files that Spark committed: part, file and number of blocks."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string())])

    def write(batches):
        part, out, n = TaskContext.get().partitionId(), None, 0
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name = f"{root}/{part:08d}-{uuid.uuid4().hex}.arrow"
        for piece in slices(batches, "text", BLOCK_BYTES):
            if out is None:
                sink = files.open_output_stream(name)
                out = pa.ipc.new_file(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            columns = [one_array(piece.column(c)).cast(t) for c, t in (("doc_id", pa.int64()), ("text", pa.large_string()))]
            out.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
            n += 1
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([n], pa.int64())], names=["part", "file", "n"])

    docs.mapInArrow(write, "part int, file string, n long").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _each(batches, home: str):
    """Blocks of the files in record batches: part, block, ids, which of them are known, bytes and
    offsets."""
    files, _ = fs.FileSystem.from_uri(home)
    for batch in batches:
        for part, name in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist()):
            with files.open_input_file(name) as file:
                reader = pa.ipc.open_file(file)
                for block in range(reader.num_record_batches):
                    held = reader.get_batch(block)
                    ids = held.column("doc_id")
                    data, at = utf8(held.column("text"))
                    yield part, block, ids.fill_null(0).to_numpy(), np.asarray(ids.is_valid()), data, at
                    del held, ids, data, at
                    pa.default_memory_pool().release_unused()


class Answers:
    """What a stage of answers says to the blocks of a writing task."""

    def __init__(self, folder: str):
        self.folder, self.part, self.by_block = folder, None, {}

    def of(self, part: int, block: int) -> list[bytes]:
        if part != self.part:
            self.part, self.by_block = part, {}
            files, names = parquet_files(f"{self.folder}/part={part}")
            for name in names:
                table = pq.read_table(files.open_input_file(name))
                for b, packed in zip(table["block"].to_pylist(), table["packed"].to_pylist()):
                    self.by_block.setdefault(b, []).append(packed)
        return self.by_block.get(block, [])


def _buckets(batches, names):
    """Rows by bucket, from batches that are sorted by it: bucket, and a list for each name."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("bucket", *names))):
            if row[0] != now and held:
                yield now, [list(c) for c in zip(*held)]
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield now, [list(c) for c in zip(*held)]


def _answers(rows: DataFrame, parts: int, path: str) -> str:
    """Write answers with a folder for each writing task."""
    rows.repartition(parts, "part").write.partitionBy("part").parquet(path)
    return re.sub("^file:/+", "/", path)


def shared_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, ``spans`` of removed bytes (start, end) in order and
    ``kept``, the bytes that remain."""
    spark = docs.sparkSession
    kept = stages(spark)
    size = docs.select(F.sum(F.octet_length(text_column(text)))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hash_buckets = max(parts, size // (8 << 20))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_column(text).alias("text"))
    blocks_at = re.sub("^file:/+", "/", kept.path("blocks"))  # a plain path is one for pyarrow, too
    written = write_blocks(rows, blocks_at, kept.path("files"))
    n_files, n_blocks = written.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    source = written.select("part", "file").repartition(max(n_files, 1))  # a task for each file
    every = max(n_blocks // SAMPLED_BLOCKS, 1)
    rate = max(size // every // 14 // SAMPLES, 1)

    def hashed(batches):
        for part, block, ids, known, data, at in _each(batches, blocks_at):
            hashes, _, _, _, text_no = records(data, at, known)
            order = np.lexsort((ids[text_no], hashes))
            h, d = hashes[order] | np.uint64(1), ids[text_no][order]
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            if not len(starts):
                continue
            ends = np.r_[starts[1:], len(h)] - 1
            many = d[starts] != d[ends]
            value = h[starts] ^ np.uint64(1) | many.astype(np.uint64)
            bucket = (value >> np.uint64(32)).astype(np.int64) * hash_buckets >> 32
            cuts = np.searchsorted(bucket, np.arange(hash_buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), part, np.int32)), pa.array(np.full(len(full), block, np.int32)),
                 pa.array([value[cuts[b] : cuts[b + 1]].tobytes() for b in full.tolist()], pa.binary())],
                names=["bucket", "part", "block", "hashes"],
            )

    def twice(batches):
        for _, (part, block, packed) in _buckets(batches, ("part", "block", "hashes")):
            value = [np.frombuffer(p, np.uint64) for p in packed]
            source_no = np.repeat(np.arange(len(value)), [len(v) for v in value])
            value = np.concatenate(value)
            plain = value | np.uint64(1)
            order = np.argsort(plain, kind="stable")
            p = plain[order]
            starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            count = np.diff(np.r_[starts, len(p)])
            many = (count > 1) | (np.bitwise_or.reduceat((value[order] & np.uint64(1)), starts) > 0)
            shared = np.zeros(len(value), bool)
            shared[order] = np.repeat(many, count)
            value, source_no = plain[shared], source_no[shared]
            cuts = np.searchsorted(source_no, np.arange(len(part) + 1))
            full = np.flatnonzero(np.diff(cuts)).tolist()
            if full:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[i] for i in full], pa.int32()), pa.array([block[i] for i in full], pa.int32()),
                     pa.array([value[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary())],
                    names=["part", "block", "packed"],
                )

    by_hash = source.mapInArrow(hashed, "bucket int, part int, block int, hashes binary")
    shared = by_hash.repartition(hash_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(twice, "part int, block int, packed binary")
    wanted_at = _answers(shared, parts, kept.path("wanted"))

    def wanted_of(answers, part, block, ids, known, data, at):
        """Distinct records of a block whose anchors stand in two documents."""
        wanted = np.sort(np.frombuffer(b"".join(answers.of(part, block)), np.uint64)) ^ np.uint64(1)
        return distinct_records(data, at, ids, known, np.sort(np.r_[wanted, wanted | np.uint64(1)]))

    def sampled(batches):
        answers = Answers(wanted_at)
        for part, block, ids, known, data, at in _each(batches, blocks_at):
            if int(mixed(np.array([part << 32 | block]))[0]) % every:  # for splitters only
                continue
            (rows, count, lead, _, _), _ = wanted_of(answers, part, block, ids, known, data, at)
            pick = np.flatnonzero(_digest(rows, 6) % np.uint64(rate) == 0)
            anchors = [rows[i, lead[i] : lead[i] + GRAM].tobytes() for i in pick.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.binary())], names=["anchor"])

    anchors = sorted(bytes(r[0]) for r in source.mapInArrow(sampled, "anchor binary").limit(4 * SAMPLES).collect())
    buckets = max(parts, len(anchors) * rate * every // BUCKET_RECORDS)
    splitters = np.array(sorted({anchors[i * len(anchors) // buckets] for i in range(1, buckets)} if anchors else set()), dtype=f"S{GRAM}")

    def sent(batches):
        answers = Answers(wanted_at)
        for part, block, ids, known, data, at in _each(batches, blocks_at):
            (rows, count, lead, least, largest), _ = wanted_of(answers, part, block, ids, known, data, at)
            if not len(rows):
                continue
            anchor = _cut_out(rows, np.arange(len(rows)), lead, GRAM).view(f"S{GRAM}").ravel()
            bucket = np.searchsorted(splitters, anchor, side="right")
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(len(splitters) + 2))
            size = count + LENGTH - 1
            out = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                i = order[cuts[b] : cuts[b + 1]]
                text = rows[i][np.arange(rows.shape[1]) < size[i][:, None]].tobytes()
                table = _pack(number=i.astype(np.uint32), count=count[i].astype(np.uint8), lead=lead[i].astype(np.uint8), least=least[i], largest=largest[i])
                out.append((b, part, block, table, pa.compress(text, "zstd", asbytes=True), len(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))],
                names=["bucket", "part", "block", "table", "text", "size"],
            )

    def compared(batches):
        for _, (part, block, tables, texts, sizes) in _buckets(batches, ("part", "block", "table", "text", "size")):
            parts_ = [_unpack(t) for t in tables]
            sender = np.repeat(np.arange(len(parts_)), [t.num_rows for t in parts_])
            table = pa.concat_tables(parts_)
            number, count, lead, least, largest = (table[c].to_numpy().astype(np.int64) for c in ("number", "count", "lead", "least", "largest"))
            data = np.frombuffer(b"".join(pa.decompress(t, s, "zstd", asbytes=True) for t, s in zip(texts, sizes)), np.uint8)
            size = count + LENGTH - 1
            rows = content(data, np.cumsum(size) - size, count)
            record, window, n, low = least_ids(rows, count, lead, least, largest)
            order = np.argsort(sender[record], kind="stable")
            record, window, n, low = record[order], window[order], n[order], low[order]
            cuts = np.searchsorted(sender[record], np.arange(len(parts_) + 1))
            full = np.flatnonzero(np.diff(cuts)).tolist()
            if full:
                packed = [
                    _pack(number=number[record[a:b]].astype(np.uint32), window=window[a:b].astype(np.uint8), n=n[a:b].astype(np.uint8), low=low[a:b])
                    for a, b in ((cuts[i], cuts[i + 1]) for i in full)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[i] for i in full], pa.int32()), pa.array([block[i] for i in full], pa.int32()), pa.array(packed, pa.binary())],
                    names=["part", "block", "packed"],
                )

    by_anchor = source.mapInArrow(sent, "bucket int, part int, block int, table binary, text binary, size long")
    runs = by_anchor.repartition(max(buckets, 1), "bucket").sortWithinPartitions("bucket").mapInArrow(compared, "part int, block int, packed binary")
    runs_at = _answers(runs, parts, kept.path("runs"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches):
        wanted, answers = Answers(wanted_at), Answers(runs_at)
        for part, block, ids, known, data, at in _each(batches, blocks_at):
            gone = np.zeros(len(data) + 1, np.int32)
            found = answers.of(part, block)
            if found:
                _, (number, first, owner) = wanted_of(wanted, part, block, ids, known, data, at)
                order = np.argsort(number, kind="stable")
                begin = np.searchsorted(number[order], np.arange(number.max() + 2))
                for packed in found:
                    table = _unpack(packed)
                    rec, window, n, low = (table[c].to_numpy().astype(np.int64) for c in ("number", "window", "n", "low"))
                    uses = begin[rec + 1] - begin[rec]
                    where = order[ranges(begin[rec], uses)]
                    window, n, low = np.repeat(window, uses), np.repeat(n, uses), np.repeat(low, uses)
                    hit = low < owner[where]
                    start = first[where][hit] + window[hit]
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + n[hit] + LENGTH - 1, -1)
            covered = np.cumsum(gone[:-1]) > 0
            before = np.r_[False, covered[:-1]]
            before[at[:-1][at[:-1] < len(data)]] = False
            starts = np.flatnonzero(covered & ~before)
            after = np.r_[covered[1:], False]
            after[at[1:][at[1:] > 0] - 1] = False
            ends = np.flatnonzero(covered & ~after) + 1
            of = np.searchsorted(at, starts, side="right") - 1
            kept_bytes = data[~covered]
            left = np.r_[0, np.cumsum(~covered)][at]
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(of, np.arange(len(at))).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array((starts - at[of]).astype(np.int32)), pa.array((ends - at[of]).astype(np.int32))], names=["start", "end"]),
            )
            kept_column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(kept_bytes)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~known), pa.array(np.diff(at)), pa.array(np.diff(at) - np.diff(left)), spans.cast(span), kept_column.cast(pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return source.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")
