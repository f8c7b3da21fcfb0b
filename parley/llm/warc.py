"""WARC archives: written member by member, and read back by a reader that salvages what it can."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import materialize, scratch_path

#: Bytes of payload after which a new archive is begun; a file is read by one task.
ARCHIVE_BYTES = 8 << 20
VERSION = b"WARC/1.1"
GZIP = b"\x1f\x8b\x08"
#: Bytes of an archive that are read at a time, and bytes of payloads that are handed on together.
BLOCK_BYTES = 1 << 20
OUT_BYTES = 8 << 20
OUT_ROWS = 10_000
#: Bytes of archives for each reading task.
TASK_BYTES = 32 << 20
_STEP = 1 << 12
_VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
_DATE = "2000-01-01T00:00:00Z"


def uri(path: str) -> str:
    """A path as Spark writes it, as pyarrow's file systems know it."""
    return re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/(?!/)", "file:///", path))


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int, url: str | None, kind: str, payload: bytes, refers: int | None, size: int, sha: str) -> bytes:
    """One record as a gzip member. A revisit names the response and has no payload of its own."""
    body = b"" if kind == "revisit" else payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{page}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{sha}",
        "WARC-Block-Digest": f"sha1:{digest(body)}",
        "X-Payload-Length": str(size),
        "Content-Type": "text/html",
    }
    if refers is not None:
        head["WARC-Refers-To"] = f"<urn:page:{refers}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head["Content-Length"] = str(len(body))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    whole = VERSION + b"\r\n" + lines + b"\r\n" + body + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(whole) + squeeze.flush()


class _Source:
    """An archive of any size, read in blocks; what was searched for is remembered, so no bytes are searched twice."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size = file, file.size()
        self.block, self.block_at = b"", 0
        self.known: dict[bytes, tuple[int, int]] = {}

    def read(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if n > BLOCK_BYTES // 4:
            return self.file.read_at(n, at)
        if at < self.block_at or at + n > self.block_at + len(self.block):
            self.block, self.block_at = self.file.read_at(min(BLOCK_BYTES, self.size - at), at) if n else b"", at
        return self.block[at - self.block_at : at - self.block_at + n]

    def find(self, what: bytes, at: int) -> int:
        """The next place of some bytes; the size if there is none."""
        start, place = self.known.get(what, (1, 0))
        if start <= at <= place:
            return place
        place, step = at, _STEP
        while place < self.size:
            piece = self.read(place, step)
            found = piece.find(what)
            if found >= 0 or place + len(piece) >= self.size:
                place = place + found if found >= 0 else self.size
                break
            place += len(piece) - len(what) + 1
            step = min(2 * step, BLOCK_BYTES)
        self.known[what] = (at, min(place, self.size))
        return self.known[what][1]


def _parse(data: _Source, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """The record at a place of uncompressed bytes: header, body and end; None if any check fails."""
    if not _VERSION_LINE.match(data.read(at, 32)):
        return None
    stop = data.find(b"\r\n\r\n", at)
    if stop >= data.size:
        return None
    lines = data.read(at, stop - at).decode("utf-8", "replace").split("\r\n")[1:]
    if not all(":" in line for line in lines):
        return None
    head = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
    length = head.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        return None
    end = stop + 4 + int(length)
    if end + 4 > data.size or data.read(end, 4) != b"\r\n\r\n":
        return None
    body = data.read(stop + 4, int(length))
    block = head.get("warc-block-digest", "")
    if block.startswith("sha1:") and block[5:] != digest(body):
        return None
    return head, body, end + 4


def _inflate(data: _Source, at: int) -> tuple[bytes, int] | None:
    """The gzip member at a place and its end; None if it is broken or its checksum fails."""
    member = zlib.decompressobj(31)
    out, step = [], _STEP
    while not member.eof:
        piece = data.read(at, step)
        if not piece:
            return None
        try:
            out.append(member.decompress(piece))
        except zlib.error:
            return None
        at += len(piece)
        step = min(2 * step, BLOCK_BYTES)
    return b"".join(out), at - len(member.unused_data)


def _member(data: _Source, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int] | None:
    """All records of the gzip member at a place and where it ends; None unless everything in it is sound."""
    inflated = _inflate(data, at)
    if inflated is None:
        return None
    inside = _Source(pa.BufferReader(inflated[0]))
    out, inner = [], 0
    while inner < inside.size:
        found = _parse(inside, inner)
        if found is None:
            return None
        out.append(found[:2])
        inner = found[2]
    return out, inflated[1]


def salvage(archive: bytes | pa.NativeFile) -> Iterator[tuple[str, int, int, dict[str, str] | None, bytes]]:
    """Records and quarantined gaps of an archive: kind, start, end, header and body, in the order of the bytes.

    Members may be compressed or plain, also in one file. Where a check fails
    (checksum, version line, length, end mark or digest), the reader looks for the
    next place at which a whole sound member or record begins, logs the bytes
    before it as one gap, and reads on from there. Bytes at the end that lead to
    no record are a gap too. The archive is read in blocks, never as a whole; one member is held at a time,
    and time grows with the archive's bytes, however many members it has.
    """
    data = _Source(archive if isinstance(archive, pa.NativeFile) else pa.BufferReader(archive))
    at, gap = 0, None
    while at < data.size:
        found = None
        start = data.read(at, 5)
        if start.startswith(GZIP):
            found = _member(data, at)
        elif start == b"WARC/":
            plain = _parse(data, at)
            found = ([plain[:2]], plain[2]) if plain else None
        if found is None:
            gap = at if gap is None else gap
            at = min(data.find(GZIP, at + 1), data.find(b"WARC/", at + 1))
            continue
        if gap is not None:
            yield "gap", gap, at, None, b""
            gap = None
        for head, body in found[0]:
            yield "record", at, found[1], head, body
        at = found[1]
    if gap is not None:
        yield "gap", gap, data.size, None, b""


def roles(pages: DataFrame, key: str = "page_id", html: str = "html", least: int = 0) -> DataFrame:
    """Columns key, ``payload_digest``, ``payload_bytes`` and ``refers_to`` (null for responses) of every row.

    Of equal payloads of ``least`` bytes or more, the row with the largest key is the
    response. Payloads are compared by digest and length; one number a digest is
    gathered before anything moves, so a payload that a third of all rows share costs one row a task.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    marked = pages.select(
        F.col(f"`{key}`").alias("key"), F.sha1(payload).alias("sha"), F.octet_length(payload).cast("long").alias("size")
    )
    marked = materialize(marked, "payloads")
    largest = marked.where(F.col("size") >= least).groupBy("sha", "size").agg(F.max("key").alias("largest"))
    named = marked.join(largest, ["sha", "size"], "left")
    refers = F.when(F.col("largest") != F.col("key"), F.col("largest"))
    return named.select("key", "sha", "size", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write one record a row to archives under ``path``; columns ``file``, ``records`` and ``bytes`` of each archive.

    A task writes each archive under a name of its own and then moves it to its
    final name, so a task that is lost or runs twice leaves no half archive, and
    only archives that this table names count. Rows are joined with their roles by key and
    digest, which moves every page once unless the roles are small enough for Spark to broadcast.
    """
    named = roles(pages, key, html, least)
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    # Repeated rows have one role each: what they refer to depends on key and payload only.
    unique = named.groupBy("key", "sha").agg(F.max("refers_to").alias("refers_to"))
    rows = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    placed = rows.join(unique, (rows["key"].eqNullSafe(unique["key"])) & (rows["sha"] == unique["sha"]), "left")
    placed = placed.select(rows["key"], "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri(path))
        store.create_dir(base, recursive=True)
        out = _Archives(store, base, TaskContext.get().partitionId())
        for batch in batches:
            for page, target, text, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (text or "").encode()
                kind = "response" if refers is None else "revisit"
                out.add(record(page, target, kind, payload, refers, len(payload), digest(payload)), len(payload))
        yield pa.RecordBatch.from_pylist(out.close(), pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return placed.mapInArrow(run, "file string, records long, bytes long")


class _Archives:
    """Archives that one task writes, each begun when the last is full."""

    def __init__(self, store: fs.FileSystem, base: str, part: int):
        self.store, self.base, self.part = store, base, part
        self.members: list[bytes] = []
        self.size, self.done = 0, []

    def add(self, member: bytes, size: int) -> None:
        self.members.append(member)
        self.size += size
        if self.size >= ARCHIVE_BYTES:
            self._write()

    def _write(self) -> None:
        name = f"part-{self.part:05d}-{len(self.done):04d}-{uuid.uuid4().hex}.warc.gz"
        whole = b"".join(self.members)
        final, draft = posixpath.join(self.base, name), posixpath.join(self.base, f".{name}")
        with self.store.open_output_stream(draft, compression=None) as f:
            f.write(whole)
        self.store.move(draft, final)
        self.done.append({"file": name, "records": len(self.members), "bytes": len(whole)})
        self.members, self.size = [], 0

    def close(self) -> list[dict]:
        if self.members:
            self._write()
        return self.done


_READ = "file string, kind string, start long, stop long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


_READ_KINDS = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def _number(value: str | None) -> int | None:
    tail = (value or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def _row(file: str, kind: str, start: int, stop: int, head: dict[str, str] | None, body: bytes) -> tuple:
    """One record or gap as a row of the reader."""
    if head is None:
        return (file, kind, start, stop, *[None] * 7)
    what = head.get("warc-type")
    revisit = what == "revisit"
    size = head.get("x-payload-length", "") if revisit else str(len(body))
    sha = head.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest(body)
    return (
        (file, kind, start, stop, _number(head.get("warc-record-id")), head.get("warc-target-uri"), what)
        + (_number(head.get("warc-refers-to")), int(size) if size.isdigit() else None, sha)
        + (None if revisit else body,)
    )


def read_archives(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """Records (``kind`` record) and quarantined gaps (``kind`` gap) of all archives under ``path``.

    Each row has its file and the bytes it came from. A gap has no other columns;
    a payload is null for revisits. ``files`` names the archives that count
    (columns ``file`` and ``bytes``); others, left by tasks that ran twice, are not read. Only names and
    lengths move; each archive is read in blocks by one task.
    """
    if files is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path)
        files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    count, size = files.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(count, max(-(-size // TASK_BYTES), spark.sparkContext.defaultParallelism)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _READ.split(", ")]
        store, base = fs.FileSystem.from_uri(uri(path))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, _READ_KINDS, strict=True)], names)

        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_file(posixpath.join(base, file)) as archive:
                    for found in salvage(archive):
                        rows.append(_row(file, *found))
                        held += len(found[4])
                        if held >= OUT_BYTES or len(rows) >= OUT_ROWS:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.select("file").repartition(tasks).mapInArrow(run, _READ)


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write the rows to new archives in the shared folder and read them back, gaps included.

    A null payload is empty, a null key is written as no number and read back as null.
    An empty table leaves no archives and gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    files = materialize(write_archives(pages, path, key, url, html, least), "warc-files")
    if files.isEmpty():
        return spark.createDataFrame([], _READ)
    return read_archives(spark, path, files)
