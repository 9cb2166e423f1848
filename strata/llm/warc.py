"""WARC archives: one gzip stream per archive in, one gzip member per record out.

``write_archives`` packs pages into archives, each a single gzip stream as many
crawlers leave them, which can only be read from its start.  ``normalise``
streams through each archive once, writes every record as a gzip member of its
own and a sidecar index with a JSON line per record (archive, offset, length,
type, ids, digest); ``read_records`` then fetches records by offset, in any
order and in parallel.

Of pages with equal payloads of ``LEAST_SHARED`` bytes or more the one with the
smallest id is a response; the others are revisits, which name it and hold no
payload.  Digests are grouped with partial aggregation, and the join that
brings the first id back is one that Spark can split, so a payload that a third
of all pages share gathers in no task.

Files are reached through ``pyarrow.fs``, so the folder must be one that all
workers share and that it knows (``file``, ``hdfs``, ``s3``, ``gs``).  A file is
written under a name of its attempt and renamed when complete.  Archives of
lost attempts are in no manifest; normalised names depend on the archive alone,
so a repeated task replaces its file by an equal one.  Memory: a writer holds a
row, a normaliser ``PIECE`` bytes of a record, a reader one record.

Null payloads are empty, null addresses are left out, characters that a header
cannot hold are percent-encoded.  Rows without an id are revisits of a page
with an id and the same payload, else responses.  Rows that repeat both id and
payload are all responses, or all revisits.  An empty table gives no archive
and no record.  Other columns are not read.  A damaged or cut archive is an
error that names it.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.words import bounded_batches
from strata.session import settle, struct

#: Equal payloads of this size or more are stored once.
LEAST_SHARED = 100
#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 256_000_000
PIECE = 1 << 18
LONGEST_LINE = 1 << 16
LEVEL = 6
MOST_TASKS = 20_000
#: Result bytes in a batch of records that were read.
READ_BYTES = 4_000_000

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = re.compile(r"<urn:page:(-?\d+|none):")
_LONG, _TEXT = T.LongType(), T.StringType()
MANIFEST = struct(archive=_TEXT, records=_LONG)
INDEX = struct(
    archive=_TEXT, offset=_LONG, length=_LONG, type=_TEXT, record_id=_TEXT, refers_to=_TEXT, uri=_TEXT, date=_TEXT,
    digest=_TEXT,
)
RECORDS = struct(
    page_id=_LONG, url=_TEXT, record_type=_TEXT, refers_to=_LONG, declared_bytes=_LONG, declared_digest=_TEXT,
    payload=T.BinaryType(),
)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file, and its path there."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(path)


def with_first_copies(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and, for revisits, ``first``: the response's id."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest")
    )
    size = F.octet_length("payload")
    firsts = (
        rows.where(size >= least)
        .groupBy(F.col("digest").alias("key"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    # short payloads match nothing, and are dealt out by more than their digest
    key = F.when(size >= least, F.col("digest")).otherwise(F.concat_ws("-", F.lit("short"), "page_id", "url"))
    return (
        rows.withColumn("key", key)
        .join(firsts, "key", "left")
        .withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
        .withColumn("size", size.cast("long"))
        .withColumn("payload", F.when(F.col("first").isNull(), F.col("payload")))
        .select("page_id", "url", "payload", "size", "digest", "first")
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest[:32]}>"


def page_of(record: str | None) -> int | None:
    found = _PAGE.match(record or "")
    return int(found[1]) if found and found[1] != "none" else None


def _head(fields: list[tuple[str, str | None]], size: int) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in fields if v is not None]
    return f"WARC/1.1\r\n{''.join(lines)}Content-Length: {size}\r\n\r\n".encode()


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str,
                first: int | None, date: str) -> list[bytes]:
    """The parts of a response, or of a revisit if ``first`` names the response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    uri = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~|{}^`\\\"<>")
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", None if first is None else _PROFILE),
        ("WARC-Refers-To", None if first is None else record_id(first, digest)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    body = [] if first is not None or not payload else [payload]
    return [_head(fields, len(http) + sum(map(len, body))), http, *body, b"\r\n\r\n"]


class _Archive:
    """One gzip stream that is being written."""

    def __init__(self, folder: str, name: str, date: str) -> None:
        self.path = f"{folder}/{name}"
        store, at = _store(self.path)
        store.create_dir(at.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(at, compression=None)
        self.zip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.records = self.payload = 0
        info = b"software: strata\r\nformat: WARC File Format 1.1\r\n"
        fields = [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", date),
            ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
        ]
        self.add([_head(fields, len(info)), info, b"\r\n\r\n"])

    def add(self, parts: list[bytes]) -> None:
        for part in parts:
            self.out.write(self.zip.compress(part))
            self.payload += len(part)
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.out.write(self.zip.flush())
        self.out.close()
        return self.path, self.records


def _manifest(found: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64())],
        names=["archive", "records"],
    )


def write_archives(pages: DataFrame, folder: str, date: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of ``with_first_copies`` to archives, each one gzip stream; the manifest of those committed."""
    bounded_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        # the attempt is part of the name: what a lost attempt left is in no manifest
        prefix = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        archive, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if archive is None:
                    archive = _Archive(folder, f"{prefix}-{len(done):05d}.warc.gz", date)
                archive.add(page_record(*row, date))
                if archive.payload >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield _manifest(done)

    return settle(
        pages.select("page_id", "url", "payload", "size", "digest", "first").mapInArrow(write, MANIFEST), "archives"
    )


def read_head(stream: gzip.GzipFile) -> tuple[bytes, dict[str, str]] | None:
    """The next record's head: its bytes and its fields in lower case; None at the end."""
    line = stream.readline(LONGEST_LINE)
    while line in (b"\r\n", b"\n"):
        line = stream.readline(LONGEST_LINE)
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record begins with {line[:40]!r}")
    raw, fields, name = [line], {}, ""
    while True:
        line = stream.readline(LONGEST_LINE)
        if not line.endswith(b"\n"):
            raise ValueError("a record's head is cut off or too long")
        raw.append(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            break
        if text[0] in " \t":  # a field that goes on
            fields[name] = f"{fields.get(name, '')} {text.strip()}"
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError("a record has no length")
    return b"".join(raw), fields


def records_as_members(source, sink) -> Iterator[dict]:
    """Copy a WARC stream record by record, each to a gzip member; one index entry per record."""
    offset = 0
    with gzip.GzipFile(fileobj=source) as stream:
        while (found := read_head(stream)) is not None:
            head, fields = found
            member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            length = sink.write(member.compress(head))
            left = int(fields["content-length"])
            while left:
                piece = stream.read(min(left, PIECE))
                if not piece:
                    raise ValueError("a record is cut off")
                length += sink.write(member.compress(piece))
                left -= len(piece)
            length += sink.write(member.compress(b"\r\n\r\n") + member.flush())
            yield {
                "offset": offset,
                "length": length,
                "type": fields.get("warc-type"),
                "record_id": fields.get("warc-record-id"),
                "refers_to": fields.get("warc-refers-to"),
                "uri": fields.get("warc-target-uri"),
                "date": fields.get("warc-date"),
                "digest": fields.get("warc-payload-digest"),
            }
            offset += length


class _Counted:
    """A stream whose ``write`` gives the number of bytes, whatever the store."""

    def __init__(self, out) -> None:
        self.out = out

    def write(self, data: bytes) -> int:
        if data:
            self.out.write(data)
        return len(data)


def normalise_archive(archive: str, folder: str, attempt: str) -> tuple[str, int]:
    """Rewrite one archive into ``folder``, with its index beside it; its new path and its records."""
    base = archive.rpartition("/")[2].removesuffix(".warc.gz")
    target = f"{folder}/{base}-{hashlib.sha256(archive.encode()).hexdigest()[:8]}.warc.gz"
    store, at = _store(target)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    n, marked = 0, f"{at}.{attempt}"
    source_store, source_at = _store(archive)
    try:
        with (
            source_store.open_input_stream(source_at, compression=None) as source,
            store.open_output_stream(f"{marked}.part", compression=None) as out,
            store.open_output_stream(f"{marked}.lines", compression=None) as lines,
        ):
            for entry in records_as_members(source, _Counted(out)):
                lines.write(json.dumps({"archive": target, **entry}).encode() + b"\n")
                n += 1
    except (ValueError, EOFError, OSError, zlib.error) as error:
        raise RuntimeError(f"{archive}: {error}") from error
    store.move(f"{marked}.part", at)
    store.move(f"{marked}.lines", f"{at}.idx")
    return target, n


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive (column ``archive``) with one member per record; the index of all records."""
    spark = archives.sparkSession

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                yield _manifest([normalise_archive(archive, folder, attempt)])

    n = archives.count()
    if not n:
        return spark.createDataFrame([], INDEX)
    done = settle(archives.select("archive").repartition(min(n, MOST_TASKS)).mapInArrow(rewrite, MANIFEST), "members")
    index = spark.read.schema(INDEX).json(f"{folder}/*.idx")
    written, listed = done.agg(F.sum("records")).first()[0], index.count()
    if written != listed:
        raise RuntimeError(f"{folder}: {written} records were written and {listed} are listed")
    return index


def record_at(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record in one member."""
    data = gzip.decompress(file.read_at(length, offset))
    end = data.index(b"\r\n\r\n") + 4
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:-2]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, data[end : end + int(fields["content-length"])]


def _page_row(fields: dict[str, str], block: bytes) -> tuple:
    """A row of RECORDS; the payload's digest is checked where there is a payload."""
    end = block.index(b"\r\n\r\n") + 4
    size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", block[:end])[1])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2]
    payload = block[end:] if kind == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise RuntimeError(f"{fields['warc-record-id']}: payload and digest differ")
    return (
        page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, page_of(fields.get("warc-refers-to")),
        size, digest, payload,
    )


_READ = pa.schema(
    [
        pa.field(f.name, pa.int64() if f.dataType == _LONG else pa.string() if f.dataType == _TEXT else pa.binary())
        for f in RECORDS
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _READ, strict=True)], schema=_READ)


def read_records(index: DataFrame, tasks: int | None = None) -> DataFrame:
    """Pages of the records that an index lists, each fetched by its offset."""
    spark = index.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, rows, held = None, None, [], 0
        for batch in batches:
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != path:
                    if file is not None:
                        file.close()
                    store, at = _store(archive)
                    path, file = archive, store.open_input_file(at)
                rows.append(_page_row(*record_at(file, offset, length)))
                held += len(rows[-1][-1] or b"") + 200
                if held >= READ_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if file is not None:
            file.close()
        if rows:
            yield _batch(rows)

    wanted = index.where(F.col("type").isin("response", "revisit")).select("archive", "offset", "length")
    return (
        wanted.repartitionByRange(tasks, "archive", "offset")
        .sortWithinPartitions("archive", "offset")
        .mapInArrow(read, RECORDS)
    )
