"""WARC archives: a writer with revisit records, and a reader that splits archives.

The writer makes one record of each page. Of pages with equal payloads of at least
``REVISIT_BYTES`` the one with the largest id is a response; the others are revisits that refer to
it and hold its HTTP header without the payload. Smaller payloads are always responses, and so
are pages without an id; rows that repeat the largest id are responses each.

The reader cuts archives into byte ranges. A task looks for the magic in its range, reads the
header at each place and emits where that record's successor begins, followed to the first one
beyond the range. A magic inside a payload gives such a candidate, too. Pointer jumping from the
start of each file then finds the places that real records lead to: each round doubles the
distance of a jump, so a file of r ranges takes log2(r) rounds on a narrow table. A second pass
reads the records of each range from its verified entry on. An archive that is cut off is read
up to the damage.

Null html is the empty payload, null urls are left out. An empty table gives no archives.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.llm.common import drop, one_array, slices, stages, text_column

MAGIC = b"WARC/1.0\r\n"
REVISIT_BYTES = 1000
#: Bytes after which the writer begins a new archive, and of a reader's range.
ARCHIVE_BYTES, RANGE_BYTES = 64 << 20, 4 << 20
#: Bytes that the reader takes for a header at first; of a longer one it reads on.
HEADER_BYTES = 1 << 16

POINTERS = "file string, size long, offset long, exit long"
RECORDS = ("file string, offset long, record_id string, uri string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to string, payload binary")


def record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record. The block of a revisit is the HTTP header alone, as the standard has it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    header = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url:
        header.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        header += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    header += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
               f"Content-Length: {len(block)}"]
    return MAGIC + "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def revisits(pages: DataFrame) -> DataFrame:
    """page_id and digest of pages to be written as revisits, and the page they refer to."""
    heavy = pages.where(F.octet_length("html") >= REVISIT_BYTES).select("page_id", "digest")
    groups = heavy.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
    groups = groups.where("least < refers_to").drop("least")
    return heavy.join(groups, "digest").where("page_id < refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Archives below ``folder``/archives, and the list of those that Spark committed at
    ``folder``/list. The folder is one that all executors share."""
    spark = pages.sparkSession
    kept = stages(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_column(html).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    again = kept.keep(revisits(rows), "revisits")
    home = re.sub("^file:/+", "/", f"{folder}/archives")

    def write(batches):
        part, out, done = TaskContext.get().partitionId(), None, []
        files, root = fs.FileSystem.from_uri(home)
        files.create_dir(root, recursive=True)
        for batch in slices(batches, "html"):
            columns = [one_array(batch.column(c)).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
            for page, uri, text, digest, refers in zip(*columns):
                if out is None:
                    name = f"{part:08d}-{len(done):06d}-{uuid.uuid4().hex}.warc"
                    out = files.open_output_stream(f"{root}/{name}")
                out.write(record("" if page is None else str(page), uri, text.encode(), digest, None if refers is None else str(refers)))
                if out.tell() >= ARCHIVE_BYTES:
                    done.append((name, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((name, out.tell()))
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "size"])

    joined = rows.join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    joined.mapInArrow(write, "file string, size long").write.parquet(f"{folder}/list")
    drop(kept, "revisits")


def parsed(header: bytes) -> dict[str, str] | None:
    """Fields of a record header, or None if it is none."""
    lines = header.decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields if fields.get("content-length", "").isdecimal() and "warc-type" in fields else None


class Archive:
    """Reads parts of one archive; ``window`` is kept in memory."""

    def __init__(self, home: str, name: str, start: int, end: int):
        files, root = fs.FileSystem.from_uri(home)
        self.file = files.open_input_file(f"{root}/{name}")
        self.size = self.file.size()
        self.start = start
        self.window = self.file.read_at(max(min(end + HEADER_BYTES, self.size) - start, 0), start)

    def read(self, start: int, length: int) -> bytes:
        a = start - self.start
        if 0 <= a and a + length <= len(self.window):
            return self.window[a : a + length]
        return self.file.read_at(max(min(length, self.size - start), 0), start)

    def head(self, offset: int) -> bytes | None:
        """A header of any length up to its blank line; None for no whole one. A magic that begins a
        line is no field, so a search from inside a payload ends at the next such magic."""
        length, seen, left = HEADER_BYTES, 0, self.size - offset
        while True:
            head = self.read(offset, min(length, left))
            if not head.startswith(MAGIC):
                return None
            stop = head.find(b"\r\n\r\n", max(seen - 3, 0))
            if stop >= 0:
                return head[:stop]
            if length >= left or head.find(b"\r\n" + MAGIC, max(seen - len(MAGIC) - 1, 0)) >= 0:
                return None
            seen, length = length, 2 * length

    def header(self, offset: int):
        """Fields, and where the block begins and the record ends; None for no whole record."""
        head = self.head(offset)
        fields = None if head is None else parsed(head)
        if fields is None:
            return None
        begin = offset + len(head) + 4
        end = begin + int(fields["content-length"]) + 4
        if end > self.size or self.read(end - 4, 4) != b"\r\n\r\n":
            return None
        return fields, begin, end

    def magics(self, end: int):
        at = self.window.find(MAGIC)
        while 0 <= at and self.start + at < end:
            yield self.start + at
            at = self.window.find(MAGIC, at + 1)


def _ranges(listed: DataFrame, bytes_: int) -> DataFrame:
    return listed.select("file", "size", F.explode(F.expr(f"sequence(0L, greatest(size - 1, 0L), {bytes_}L)")).alias("start")).withColumn(
        "end", F.least("size", F.col("start") + bytes_)
    )


def entries(spark: SparkSession, folder: str, range_bytes: int) -> DataFrame:
    """file, size and offset of the first record that begins in each range."""
    kept = stages(spark)
    home = re.sub("^file:/+", "/", f"{folder}/archives")
    listed = spark.read.parquet(f"{folder}/list")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def point(batches):
        for batch in batches:
            found = []
            for name, size, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "start", "end"))):
                archive = Archive(home, name, start, end)
                exits: dict[int, int | None] = {}
                for offset in reversed(list(archive.magics(end))):
                    whole = archive.header(offset)
                    after = whole[2] if whole else None
                    exits[offset] = exits.get(after) if after is not None and after < end else after
                found += [(name, size, o, e) for o, e in exits.items()]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["file", "size", "offset", "exit"],
                )

    # Only what begins a file or follows some record can be an entry.
    pointers = kept.keep(_ranges(listed, range_bytes).repartition(parts, "file", "start").mapInArrow(point, POINTERS), "pointers")
    jumps = pointers.where("exit < size").select("file", "offset", "exit")
    follows = jumps.select("file", F.col("exit").alias("offset")).distinct()
    jumps = kept.keep(jumps.where("offset = 0").unionByName(jumps.where("offset > 0").join(follows, ["file", "offset"], "left_semi")), "jumps-0")
    reached = kept.keep(listed.where("size > 0").select("file", "size", F.lit(0).cast("long").alias("offset")), "reached-0")
    n, turn = reached.count(), 0
    while True:
        turn += 1
        further = reached.join(jumps, ["file", "offset"]).select("file", "size", F.col("exit").alias("offset"))
        new = kept.keep(reached.unionByName(further).distinct(), f"reached-{turn}")
        count = new.count()
        drop(kept, f"reached-{turn - 1}")
        reached = new
        if count == n:
            drop(kept, "pointers", f"jumps-{turn - 1}")
            return reached
        n = count
        second = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("beyond"))
        twice = kept.keep(jumps.join(second, ["file", "exit"]).select("file", "offset", F.col("beyond").alias("exit")), f"jumps-{turn}")
        drop(kept, f"jumps-{turn - 1}")
        jumps = twice


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the listed archives. The digest of a response is that of the payload as it
    is read; a revisit has those of the response."""
    home = re.sub("^file:/+", "/", f"{folder}/archives")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("uri", pa.string()),
                        ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                        ("refers_to", pa.string()), ("payload", pa.binary())])

    def records(batches):
        for batch in batches:
            for name, size, offset in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "offset"))):
                stop = min((offset // range_bytes + 1) * range_bytes, size)
                archive, found, held = Archive(home, name, offset, stop), [], 0
                while offset < stop and (whole := archive.header(offset)):
                    fields, begin, end = whole
                    block = archive.read(begin, end - 4 - begin)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)
                    refers = fields.get("warc-refers-to")
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") if refers else hashlib.sha1(payload).hexdigest()
                    found.append((name, offset, _urn(fields.get("warc-record-id")), fields.get("warc-target-uri"), fields["warc-type"], digest,
                                  int(length[1]) if length else len(payload), _urn(refers), payload if with_payload else None))
                    held += len(payload) * with_payload
                    offset = end
                    if held > RANGE_BYTES or len(found) >= 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in found], schema)
                        found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in found], schema)

    return entries(spark, folder, range_bytes).repartition(parts, "file", "offset").mapInArrow(records, RECORDS)


def _urn(value: str | None) -> str | None:
    return None if value is None else value.removeprefix("<urn:page:").removesuffix(">")
