"""WARC archives: written by one Spark job and read back sequentially.

Every record is a gzip member of its own, so a reader can stop and start at any
record. Payloads that occur more than once are stored once: the record with the
smallest id is a response, the others are revisits that refer to it.

The reader decompresses member by member in pieces, takes header lines up to the
empty line, then exactly ``Content-Length`` bytes, and compares both digests
with what it read. It holds one record at a time.

Archives go to the folder that all executors share, under names of their own
for each attempt; the list of archives is a stored table that names the files
of successful attempts only, so a lost executor leaves at most an unlisted file.

Defined cases: a null payload is empty; a null url is written as ``urn:none``;
a null id writes no id field and reads back as null, and among equal payloads it
comes after all ids. Rows with the same id and payload are all responses if the
id is the smallest. An empty table writes no archive and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import scratch_for, ship_package
from watchledger.scratch import Scratch

DATE = "2000-01-01T00:00:00Z"
ARCHIVE_BYTES = 64 << 20
REVISIT_BYTES = 0
LEVEL = 6
READ_TASKS = 10_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 16


class Record(NamedTuple):
    """One record: its named fields, HTTP fields and payload."""

    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


class Broken(ValueError):
    """The archive ends early, is framed wrongly or fails a digest."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A field holds no line breaks; they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def encode_record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    response_id: int | None,
    revisit: bool,
    date: str = DATE,
    level: int = LEVEL,
) -> bytes:
    """One gzip member with a response, or a revisit of ``response_id``."""
    digest = sha1_base32(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(url) if url else "urn:none"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", _PROFILE))
        fields.append(("WARC-Refers-To", _record_id(response_id, digest)))
        fields.append(("WARC-Refers-To-Page-ID", str(response_id)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = (head.encode(), block, b"\r\n\r\n")
    return b"".join([*map(packer.compress, parts), packer.flush()])


class _Members:
    """The decompressed bytes of a file of gzip members, member by member."""

    def __init__(self, source: io.RawIOBase):
        self._source, self._rest = source, b""

    def start(self) -> bool:
        """Go to the next member; False at the end of the file."""
        if not self._rest:
            self._rest = self._source.read(_PIECE)
        if not self._rest:
            return False
        self._inflate, self._ready = zlib.decompressobj(31), bytearray()
        return True

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        data = self._inflate.unconsumed_tail or self._rest or self._source.read(_PIECE)
        if not data:
            raise Broken("the archive ends within a record")
        if not self._inflate.unconsumed_tail:
            self._rest = b""
        try:
            self._ready += self._inflate.decompress(data, _PIECE)
        except zlib.error as wrong:
            raise Broken("a member does not decompress") from wrong
        if self._inflate.eof:
            self._rest = self._inflate.unused_data + self._rest
        return True

    def line(self) -> bytes:
        seen = 0
        while (end := self._ready.find(b"\r\n", max(0, seen - 1))) < 0:
            seen = len(self._ready)
            if not self._more():
                raise Broken("a record ends within its header")
        found = bytes(self._ready[:end])
        del self._ready[: end + 2]
        return found

    def exactly(self, size: int) -> bytes:
        while len(self._ready) < size:
            if not self._more():
                raise Broken("a record is shorter than its length")
        found = bytes(self._ready[:size])
        del self._ready[:size]
        return found

    def finish(self) -> None:
        """A record ends with two line breaks, and the member ends with it."""
        if self.exactly(4) != b"\r\n\r\n":
            raise Broken("a record is longer than its length")
        while self._more():
            pass
        if self._ready:
            raise Broken("a member holds more than one record")


def _fields(read_line) -> dict[str, str]:
    found = {}
    while line := read_line():
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def read_records(source: io.RawIOBase) -> Iterator[Record]:
    """Every record of one archive, in order, with its digests verified."""
    members = _Members(source)
    while members.start():
        if not members.line().startswith(b"WARC/1."):
            raise Broken("a record starts with no version line")
        fields = _fields(members.line)
        try:
            block = members.exactly(int(fields["content-length"]))
        except KeyError as missing:
            raise Broken("a record has no length") from missing
        members.finish()
        _verify(fields, "warc-block-digest", block)
        head, _, payload = block.partition(b"\r\n\r\n")
        lines = iter(head.split(b"\r\n")[1:])
        http = _fields(lambda lines=lines: next(lines, b""))
        if fields.get("warc-type") == "response":
            _verify(fields, "warc-payload-digest", payload)
            if int(http.get("content-length", len(payload))) != len(payload):
                raise Broken("a payload has another length than its header says")
        yield Record(fields, http, payload)


def _verify(fields: dict[str, str], name: str, data: bytes) -> None:
    stated = fields.get(name)
    if stated is not None and stated != f"sha1:{sha1_base32(data)}":
        raise Broken(f"{name} differs from what was read")


# -- Spark jobs --------------------------------------------------------------


def assign_records(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Each page with its payload and, for a repeated one, the first page's id.

    Digests are grouped with a map-side minimum; only digests that repeat are
    joined back, and that join can be split where one digest is frequent.
    """
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        rows.where(F.octet_length("payload") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .where("n > 1")
        .select("digest", "first_id")
    )
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "first_id", revisits.alias("revisit")
    )


#: Hadoop's names of stores that the Arrow library calls otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and the folder's path in it.

    ``file``, ``hdfs`` and ``viewfs`` (with libhdfs on the worker), ``s3``, ``s3a``, ``gs`` and
    ``abfs`` are understood. Credentials are the worker's own.
    """
    scheme, colon, rest = folder.partition(":")
    if colon and scheme in _SCHEMES:
        folder = f"{_SCHEMES[scheme]}:{rest}"
    try:
        return fs.FileSystem.from_uri(folder)
    except pa.ArrowInvalid as error:
        raise ValueError(
            f"archives cannot be kept at {folder}: use file, hdfs, s3a, gs or abfs"
        ) from error


def write_archives(
    records: DataFrame,
    folder: str,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = DATE,
    level: int = LEVEL,
) -> DataFrame:
    """Write records under ``folder``; one row per archive: path, records, bytes.

    The result is lazy and writes when it is evaluated: store it before use.
    """
    ship_package(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        out, path, count, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"path": [path], "records": [count], "bytes": [size]}
            )

        for batch in batches:
            ids, urls, payloads, firsts, revisits = batch.columns
            for i in range(batch.num_rows):
                if out is not None and size >= archive_bytes:
                    yield closed()
                    out = None
                if out is None:
                    store.create_dir(root, recursive=True)
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = encode_record(
                    ids[i].as_py(),
                    urls[i].as_py(),
                    payloads[i].as_py(),
                    firsts[i].as_py(),
                    revisits[i].as_py(),
                    date,
                    level,
                )
                out.write(member)
                count, size = count + 1, size + len(member)
        if out is not None:
            yield closed()

    return records.mapInArrow(run, "path string, records long, bytes long")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The records of the listed archives, each archive read by one task.

    ``archives`` is a stored list; its rows are counted to size the job.
    """
    ship_package(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as source:
                    yield from _in_batches(read_records(source))

    schema = (
        "page_id long, url string, record_type string, payload binary,"
        " payload_bytes long, payload_digest string, refers_to long"
    )
    # By number: partitions by key would be merged, as paths are short.
    tasks = min(max(archives.count(), 1), READ_TASKS)
    return archives.select("path").repartition(tasks).mapInArrow(run, schema)


def _in_batches(records: Iterator[Record], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for record in records:
        rows.append(_row(record))
        held += len(record.payload)
        if held >= limit or len(rows) >= 2000:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _row(record: Record) -> tuple:
    fields = record.fields
    number = lambda name: int(fields[name]) if name in fields else None
    url = fields["warc-target-uri"]
    return (
        number("warc-page-id"),
        None if url == "urn:none" else url,
        fields["warc-type"],
        record.payload,
        int(record.http["content-length"]),
        fields["warc-payload-digest"].removeprefix("sha1:"),
        number("warc-refers-to-page-id"),
    )


_TYPES = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _TYPES)]
    return pa.RecordBatch.from_arrays(columns, schema=_TYPES)


def archive_pages(
    pages: DataFrame, scratch: Scratch | None = None, **options
) -> tuple[DataFrame, str]:
    """Write all pages; the stored list of archives, and their folder."""
    scratch = scratch_for(pages.sparkSession, scratch)
    folder = scratch.folder("warc")
    written = write_archives(assign_records(pages, **options), folder)
    return scratch.stage(written, "warc-archives"), folder
