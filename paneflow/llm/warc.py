"""WARC records in seekable Zstandard archives, and their index.

A page becomes a record (WARC 1.1): a response with its payload, or, where an equal payload of at
least ``LEAST_BYTES`` bytes has been stored under a smaller page id, a revisit of that record. Records
are grouped into frames of about ``FRAME_BYTES``, each compressed by itself; an archive ends with a seek
table (a skippable frame that lists the frames' sizes, as in the seekable Zstandard format), so that a
frame can be found and read alone, and any Zstandard reader reads the whole. The index gives for a record's
identifier the archive, the frame and the place in the unpacked frame.

How it is spread: payloads are told by their SHA-256. Only digests, ids and addresses are shuffled; what
they say about payloads that occur more than once is joined with the pages, a written table that is
broadcast while it is small. So pages go from their scan into archives, a task's rows one after the other;
a frame is what a task holds. Rows that agree in id, address and payload are summed up before they meet, so a
group of any size is one row. Archives are written below the session's shared folder, by any file system that
Arrow knows; the name of an attempt's archive is its own, and the index, written by Spark, names those of
the attempts that counted. Readers go by it, an archive (``ARCHIVE_BYTES``) to a row.

Cases: a null payload is empty, a null address missing; control characters and blanks in addresses are
percent-coded; a null id comes last and is empty in identifiers; of rows that agree in id and payload one is
the response (the least address first), the others revisit it; an empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneflow.session import scratch_path, written

FRAME_BYTES, ARCHIVE_BYTES, LEVEL = 1 << 20, 1 << 28, 3
#: Smaller payloads are stored each time.
LEAST_BYTES = 100

# Of the seekable Zstandard format, and of WARC 1.1.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RESPONSE, REVISIT = "response", "revisit"
#: The pages hold no time of capture.
NO_DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id string, archive string, frame int, frame_offset long, frame_bytes long, record_offset long, record_bytes long"
RECORDS = "record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_id string, refers_to long"


# ---- archives, in a task


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pa.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


class ArchiveWriter:
    """One archive: frames of records, then the seek table."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = opened(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)  # the name would say otherwise
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.size = self.held_bytes = 0
        self.held: list[tuple[str, bytes]] = []

    def add(self, record_id: str, record: bytes) -> list[tuple]:
        """Index rows of the frames that are full now."""
        done = self.flush() if self.held and self.held_bytes + len(record) > FRAME_BYTES else []
        self.held.append((record_id, record))
        self.held_bytes += len(record)
        return done

    def flush(self) -> list[tuple]:
        if not self.held:
            return []
        packed = self.pack.compress(b"".join(record for _, record in self.held))
        rows, place = [], 0
        for record_id, record in self.held:
            rows.append((record_id, self.path, len(self.frames), self.size, len(packed), place, len(record)))
            place += len(record)
        self.out.write(packed)
        self.frames.append((len(packed), place))
        self.size += len(packed)
        self.held, self.held_bytes = [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return rows


def seek_table(archive) -> list[tuple[int, int, int]]:
    """(offset, packed bytes, unpacked bytes) of an open archive's frames."""
    size = archive.size()
    archive.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", archive.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the archive has no seek table")
    archive.seek(size - 9 - 8 * n)
    sizes = list(struct.iter_unpack("<II", archive.read(8 * n)))
    offset, frames = 0, []
    for packed, whole in sizes:
        frames.append((offset, packed, whole))
        offset += packed
    return frames


def frame(archive, offset: int, packed: int) -> bytes:
    archive.seek(offset)
    return zstandard.ZstdDecompressor().decompress(archive.read(packed))


def record_bytes(record_id: str, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    """A response, or a revisit of ``refers``: the same headers without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    fields = [
        ("WARC-Type", REVISIT if refers else RESPONSE),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", NO_DATE),
        ("WARC-Target-URI", url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", refers and REVISIT_PROFILE),
        ("WARC-Refers-To", refers and f"<{refers}>"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "\r\n".join([VERSION, *(f"{name}: {value}" for name, value in fields if value)])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, start: int = 0) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(headers, the payload's length, the payload that is there) of the records in a frame."""
    while start < len(data):
        end = data.index(b"\r\n\r\n", start)
        version, *lines = data[start:end].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        block = data[end + 4 : end + 4 + int(headers["Content-Length"])]
        http, payload = block.split(b"\r\n\r\n", 1)
        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        yield headers, length, payload
        start = end + 4 + int(headers["Content-Length"]) + 4


def page_of(record_id: str | None) -> int | None:
    """The page id in a record's identifier."""
    number = record_id.split(":")[2] if record_id else ""
    return int(number) if number else None


def described(headers: dict[str, str], length: int, payload: bytes) -> tuple:
    """A row of ``RECORDS``; a payload that is not what its record says is an error."""
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind, mine, refers = headers["WARC-Type"], headers["WARC-Record-ID"][1:-1], headers.get("WARC-Refers-To", "")[1:-1] or None
    if kind == RESPONSE and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {mine} is damaged")
    return mine, page_of(mine), headers.get("WARC-Target-URI"), kind, length, digest, refers, page_of(refers)


# ---- tables


def _identifier(page_id: Column, digest: Column, url: Column) -> Column:
    """What all copies of a record share of their identifiers."""
    return F.concat_ws(":", F.lit("urn:page"), F.coalesce(page_id.cast("string"), F.lit("")), F.substring(digest, 1, 32), F.substring(F.md5(url), 1, 16))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, digest, base (of the identifiers), n (copies), first and refers, for the writer.

    ``refers`` is the record that others with the payload refer to, null where none is shared.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    rows = rows.withColumn("base", _identifier(F.col("page_id"), F.col("digest"), F.coalesce("url", F.lit(""))))

    # Digests and identifiers only; a copy's rows are one.
    sets = rows.groupBy("digest", "base", "page_id", "url", "size").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("page_id").isNull(), "page_id", F.coalesce("url", F.lit("")), "base")
    shared = sets.groupBy("digest").agg(F.sum("n").alias("all"), F.min(place)["base"].alias("first")).filter("all > 1")
    marks = written(
        sets.join(shared, "digest").select(F.col("base").alias("mark"), "n", F.when(F.col("size") >= LEAST_BYTES, F.col("first")).alias("first")),
        "warc-marks",
    )
    marked = rows.join(marks.dropDuplicates(["mark"]), F.col("base") == F.col("mark"), "left").drop("mark")
    # Copies of one row: one row that says how many.
    copied = marked.filter("n > 1").groupBy("page_id", "url", "digest", "base", "n", "first").agg(F.any_value("payload").alias("payload"))
    single = marked.filter("n is null or n = 1").withColumn("n", F.lit(1).cast("long"))
    kept = ["page_id", "url", "payload", "digest", "base", "n", "first"]
    return single.select(kept).unionByName(copied.select(kept))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Archives of ``records`` below ``folder``/archives; the index, written below ``folder``/index."""
    place = f"{folder}/archives"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive: ArchiveWriter | None = None
        schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for n, t in (c.split() for c in INDEX.split(", "))])

        def told(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in found], schema)

        for batch in batches:
            for i in range(batch.num_rows):
                url, payload, digest, base, n, first = (batch[c][i].as_py() for c in ("url", "payload", "digest", "base", "n", "first"))
                found = []
                for copy in range(n):
                    if archive is None:
                        archive = ArchiveWriter(place)
                    refers = f"{first}:0" if first and (first != base or copy) else None
                    found += archive.add(f"{base}:{copy}", record_bytes(f"{base}:{copy}", url, payload, digest, refers))
                    if archive.size > ARCHIVE_BYTES:
                        found += archive.close()
                        archive = None
                    if len(found) > 10_000:
                        yield from told(found)
                        found = []
                yield from told(found)
        if archive:
            yield from told(archive.close())

    index = rows.mapInArrow(work, INDEX)
    index.write.parquet(f"{folder}/index")
    return read_index(rows.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _rows(found: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in RECORDS.split(", ")), strict=True)
    schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in zip(names, kinds, strict=True)])
    return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in found], schema)


def read_archives(index: DataFrame) -> DataFrame:
    """All records of the archives that the index names, read by their seek tables, frame by frame."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["archive"].to_pylist():
                system, place = opened(path)
                with system.open_input_file(place) as archive:
                    for offset, packed, _ in seek_table(archive):
                        yield _rows([described(*record) for record in parsed(frame(archive, offset, packed))])

    archives = index.select("archive").distinct()
    # a task each, however short their names are
    return archives.repartition(max(1, archives.count())).mapInArrow(work, RECORDS)


def fetch_records(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records of ``record_ids`` (record_id) with their ``payload``, each from its frame alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = opened(row["archive"])
                with system.open_input_file(place) as archive:
                    data = frame(archive, row["frame_offset"], row["frame_bytes"])
                headers, length, payload = next(parsed(data[: row["record_offset"] + row["record_bytes"]], row["record_offset"]))
                found = _rows([described(headers, length, payload)])
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array([payload], pa.binary())], [*found.schema.names, "payload"])

    return index.join(record_ids.select("record_id").distinct(), "record_id").mapInArrow(work, f"{RECORDS}, payload binary")


def archived(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """The pages as archives below ``folder`` (a new one in the shared folder), read back as ``RECORDS``."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(records(pages, **columns), folder))
