"""WARC archives: written by the tasks that hold the pages, read back record by record.

Writing.  Payloads are grouped by SHA-256 and length; only groups of two or more rows
are joined back, to the pages' ids first and then by these to the pages, so the page with
the smallest id of each group becomes a response and the others revisit it.  Every task writes one archive, each record a gzip member of its
own, into the shared folder.  A task writes under a name of its own attempt and renames
at the end, so a lost or repeated task leaves no half archive; the list of archives is
written as a table and names exactly the finished ones.

Reading.  Archives are read front to back in small chunks.  A chunk feeds one
incremental decompressor; where a gzip member ends, its record ends.  Head lines are
split off, the block is framed by its ``Content-Length``, the block and payload digests
are computed as the bytes pass and compared with those in the head.  Memory holds one
chunk, the head, and the payload only if it is asked for.

Rows: a null payload is empty; a null url leaves out the target address; line ends and
spaces in an address are percent-encoded; a null id comes back null and counts as
larger than any other; rows that repeat both id and payload are alike, so if theirs is
the smallest id all of them are responses; empty tables give no archive and no rows;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.llm.common import small_batches
from mailspark.sources.scratch import scratch_path, written

CHUNK = 1 << 16
RECORD_ID = "urn:x-page:{}"
#: Payloads below this many bytes are never revisits.
SMALLEST_REVISIT = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class BrokenArchive(ValueError):
    """An archive that isn't framed as it should be, or whose digests don't match."""


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def sha1_of(data: bytes) -> str:
    return base32_sha1(hashlib.sha1(data))


def address(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None
) -> bytes:
    """One record, not compressed; with ``refers_to`` a revisit without the payload."""
    digest = sha1_of(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = RECORD_ID.format("" if page_id is None else page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {address(url)}"] if url is not None else []),
        f"WARC-Block-Digest: sha1:{sha1_of(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *(
            [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_ID.format(refers_to)}>"]
            if revisit
            else []
        ),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return squeeze.compress(data) + squeeze.flush()


@dataclass
class Record:
    """What the reader knows of a record; ``payload`` is None unless it was kept."""

    head: dict[str, str]
    http: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None = None


@dataclass
class _Framing:
    """Takes the bytes of one record as they come."""

    keep: bool
    head_bytes: bytearray = field(default_factory=bytearray)
    head: dict[str, str] | None = None
    http_bytes: bytearray = field(default_factory=bytearray)
    http: dict[str, str] | None = None
    left: int = 0
    after: bytearray = field(default_factory=bytearray)
    size: int = 0
    kept: io.BytesIO = field(default_factory=io.BytesIO)

    def __post_init__(self):
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.head_bytes += data
            at = self.head_bytes.find(b"\r\n\r\n")
            if at < 0:
                return
            if not self.head_bytes.startswith(b"WARC/1."):
                raise BrokenArchive("a record doesn't begin with its version")
            self.head = _fields(bytes(self.head_bytes[:at]))
            self.left = int(self.head["content-length"])
            data = bytes(self.head_bytes[at + 4 :])
        body, rest = data[: self.left], data[self.left :]
        self.left -= len(body)
        self.after += rest
        self.block.update(body)
        if self.http is None:
            self.http_bytes += body
            at = self.http_bytes.find(b"\r\n\r\n")
            if at < 0:
                return
            self.http = _fields(bytes(self.http_bytes[:at]))
            body = bytes(self.http_bytes[at + 4 :])
        self.payload.update(body)
        self.size += len(body)
        if self.keep:
            self.kept.write(body)

    def record(self) -> Record:
        if self.head is None or self.http is None or self.left or self.after != b"\r\n\r\n":
            raise BrokenArchive("a record is shorter or longer than its Content-Length")
        if self.head["warc-block-digest"] != f"sha1:{base32_sha1(self.block)}":
            raise BrokenArchive(f"block digest of {self.head['warc-record-id']}")
        stated = self.head["warc-payload-digest"].removeprefix("sha1:")
        size = int(self.http["content-length"])
        if self.head["warc-type"] == "response":
            if (size, stated) != (self.size, base32_sha1(self.payload)):
                raise BrokenArchive(f"payload of {self.head['warc-record-id']}")
        elif self.size:
            raise BrokenArchive(f"payload in the revisit {self.head['warc-record-id']}")
        payload = self.kept.getvalue() if self.keep else None
        return Record(self.head, self.http, size, stated, payload)


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in lines.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, v in pairs}


def read_records(stream, keep_payload: bool = False) -> Iterator[Record]:
    """The records of an archive of gzip members, front to back."""
    squeezed, framing = zlib.decompressobj(16 + zlib.MAX_WBITS), _Framing(keep_payload)
    begun, data = False, stream.read(CHUNK)
    while data:
        begun = True
        try:
            framing.feed(squeezed.decompress(data, CHUNK))
            while squeezed.unconsumed_tail and not squeezed.eof:
                framing.feed(squeezed.decompress(squeezed.unconsumed_tail, CHUNK))
        except zlib.error as e:
            raise BrokenArchive(str(e)) from e
        data = squeezed.unused_data if squeezed.eof else b""
        if squeezed.eof:
            yield framing.record()
            squeezed, framing = zlib.decompressobj(16 + zlib.MAX_WBITS), _Framing(keep_payload)
            begun = False
        data = data or stream.read(CHUNK)
    if begun:
        raise BrokenArchive("an archive ends within a record")


def _archive_writer(folder: str) -> Callable:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        part = f"part-{TaskContext.get().partitionId():05}-{uuid.uuid4().hex}.warc.gz"
        out, n = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    where.create_dir(root, recursive=True)
                    out = where.open_output_stream(f"{root}/{part}.open", compression=None)
                payload = (row["payload"] or "").encode()
                out.write(member(record(row["page_id"], row["url"], payload, row["refers_to"])))
                n += 1
        if out is not None:
            out.close()
            where.move(f"{root}/{part}.open", f"{root}/{part}")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{part}"], "records": [n]})

    return write


def _uri(spark: SparkSession, path: str) -> str:
    """A path without a scheme lies in the default file system, as it does for Spark."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs
    default = hadoop.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString()
    if not path.startswith("/"):
        home = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getWorkingDirectory()
        path = f"{home.toUri().getPath()}/{path}"
    return f"{'file://' if default.startswith('file:') else default.rstrip('/')}{quote(path)}"


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Archives in ``folder`` (any file system pyarrow reaches); returns (path, records)."""
    pages = small_batches(pages).select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    ).withColumns(
        {
            "digest": F.sha2(F.col("payload").cast("binary"), 256),
            "size": F.octet_length("payload"),
        }
    )
    copies = (
        pages.where(F.col("size") >= SMALLEST_REVISIT)
        .groupBy("digest", "size")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("page_id").alias("first_id"))
        .where("rows > 1")
    )
    later = F.coalesce(F.col("page_id") > F.col("first_id"), F.col("first_id").isNotNull())
    # A common payload would be one key of a join with the pages; their ids are not.
    revisits = written(
        pages.select("page_id", "digest", "size")
        .distinct()
        .join(
            written(copies.select("digest", "size", "first_id"), "payload-copies"),
            ["digest", "size"],
        )
        .where(later)
        .select(F.col("page_id").alias("id"), F.col("digest").alias("of"), F.col("first_id").alias("refers_to")),
        "revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of"))
    marked = pages.join(revisits, same, "left").select("page_id", "url", "payload", "refers_to")
    folder = _uri(pages.sparkSession, folder)
    archives = marked.mapInArrow(_archive_writer(folder), "path string, records long")
    return written(archives, "archives")


def read_archives(archives: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Every record of the archives in column ``path``, verified, one row each.

    page_id, url, payload_bytes and payload_digest (of the full payload, also for
    revisits), record_type, refers_to, payload (null unless kept, and for revisits).
    """

    def number(name: str | None) -> int | None:
        digits = (name or "").removeprefix("<" + RECORD_ID.format("")).removesuffix(">")
        return int(digits) if digits else None

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_stream(name, compression=None) as stream:
                    rows: list[tuple] = []
                    size = 0
                    for r in read_records(stream, keep_payload):
                        rows.append(
                            (
                                number(r.head["warc-record-id"]),
                                r.head.get("warc-target-uri"),
                                r.payload_bytes,
                                r.payload_digest,
                                r.head["warc-type"],
                                number(r.head.get("warc-refers-to")),
                                None if r.head["warc-type"] == "revisit" else r.payload,
                            )
                        )
                        size += len(r.payload or b"")
                        if len(rows) >= 4096 or size >= 1 << 23:
                            yield _rows(rows)
                            rows, size = [], 0
                    yield _rows(rows)

    return archives.repartition(max(1, archives.count())).mapInArrow(
        read,
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary",
    )


_READ_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _READ_SCHEMA]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _READ_SCHEMA)], schema=_READ_SCHEMA
    )


def round_trip(spark: SparkSession, pages: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Write archives into the shared folder and read them back."""
    return read_archives(write_archives(pages, scratch_path(spark, "warc")), keep_payload)
