"""WARC archives as a chunked record table.

``write`` makes one archive for each task, in the shared folder: a gzip member for each record.
``chunks`` streams archives back as rows (record, chunk number) of at most CHUNK bytes with the
SHA-1 of the payload up to there, so the last chunk of a record carries the whole digest and
neither side holds a whole compressed or decoded record.  ``records`` keeps those last rows.

Of records with equal payloads of at least MIN_REVISIT bytes, the one with the largest page_id
is the response; others are revisits that refer to it, without a body, but with the digest and
length of the full payload.  Equality is that of SHA-1 and length.

An archive is written under a name of its own attempt, and only the names that a successful task
reports are read; a lost executor costs the repetition of its tasks.  The names are a table.

Defined results: null html is an empty payload.  Rows without page_id are responses.  Rows that
repeat a page_id get a record each (with equal payloads they are all responses if that id is the
largest).  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posofold.llm.common import scratch, stored

CHUNK, MIN_REVISIT = 64 << 10, 1000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"
_CHUNK_ROW = (
    "page_id long, record_type string, refers_to long, uri string, chunk int, bytes binary, digest string, "
    "payload_bytes long, last boolean"
)


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _head(page_id, uri, kind, refers_to, sha1: bytes, size: int, http: int) -> bytes:
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": _DATE,
        "WARC-Target-URI": "".join((uri or "").split()),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha1).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(size + http if kind == "response" else 0),
        "X-Payload-Length": str(size),
    }
    if kind == "revisit":
        fields["WARC-Refers-To"] = _name(refers_to)
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _place(folder)
        name, out = f"{path}/{uuid.uuid4().hex}.warc.gz", None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "record_type", "refers_to", "sha1")]
            for i in range(batch.num_rows):
                page_id, uri, payload, kind, refers_to, sha1 = (c[i] for c in columns)
                out = out or system.open_output_stream(name, compression=None)
                data = memoryview(payload.as_buffer())
                http = _HTTP.format(len(data)).encode()
                press = zlib.compressobj(1, zlib.DEFLATED, 31)
                head = _head(page_id.as_py(), uri.as_py(), kind.as_py(), refers_to.as_py(), sha1.as_py(), len(data), len(http))
                out.write(press.compress(head))
                if kind.as_py() == "response":
                    out.write(press.compress(http))
                    for start in range(0, len(data), CHUNK):
                        out.write(press.compress(data[start : start + CHUNK]))
                out.write(press.compress(b"\r\n\r\n") + press.flush())
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["archive"])

    return write


class _Stream:
    """Bytes of an archive of gzip members, in pieces."""

    def __init__(self, source):
        self.source, self.inflate, self.ready = source, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Decode at most CHUNK further bytes; false at the end."""
        while True:
            if self.inflate.eof:
                raw, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            else:
                raw = self.inflate.unconsumed_tail
            raw = raw or self.source.read(CHUNK)
            if not raw:
                return False
            if got := self.inflate.decompress(raw, CHUNK):
                self.ready += got
                return True

    def line(self) -> bytes | None:
        while b"\r\n" not in self.ready:
            if not self.more():
                return None
        line, _, self.ready = self.ready.partition(b"\r\n")
        return line

    def some(self, most: int) -> bytes:
        while len(self.ready) < min(most, CHUNK) and self.more():
            pass
        got, self.ready = self.ready[:most][:CHUNK], self.ready[min(most, CHUNK) :]
        return got


def _fields(stream: _Stream) -> dict[str, str] | None:
    """Header fields of the next record, by lower-case name; none at the end."""
    line = stream.line()
    while line == b"":
        line = stream.line()
    if line is None:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    found = {}
    while line := stream.line():
        key, _, value = line.decode("utf-8").partition(":")
        found[key.strip().lower()] = value.strip()
    return found


def _page(name: str | None) -> int | None:
    digits = (name or "").rpartition(":")[2].rstrip(">")
    return int(digits) if digits else None


def _read(folder: str):
    def rows_of(name: str, system) -> Iterator[tuple]:
        with system.open_input_stream(name, compression=None) as source:
            stream = _Stream(source)
            while (fields := _fields(stream)) is not None:
                left, length = int(fields["content-length"]), int(fields["x-payload-length"])
                about = _page(fields["warc-record-id"]), fields["warc-type"], _page(fields.get("warc-refers-to")), fields["warc-target-uri"]
                declared = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                if fields["warc-type"] != "response":
                    yield (*about, 0, b"", declared, length, True)
                    continue
                while line := stream.line():  # the HTTP head
                    left -= len(line) + 2
                left -= 2
                digest, number, size = hashlib.sha1(), 0, 0
                while True:
                    data = stream.some(left)
                    left -= len(data)
                    digest.update(data)
                    size += len(data)
                    if (left and not data) or (not left and (digest.hexdigest(), size) != (declared, length)):
                        raise ValueError(f"record {about[0]} of {name} is damaged")
                    yield (*about, number, data, digest.hexdigest(), size, not left)
                    number += 1
                    if not left:
                        break

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _place(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.bool_()]
        names = [x.split()[0] for x in _CHUNK_ROW.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        rows, size = [], 0
        for archives in batches:
            for name in archives.column("archive").to_pylist():
                for row in rows_of(name, system):
                    rows.append(row)
                    size += len(row[5]) + 200
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    return read


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives of pages (page_id, url, html) to a folder; a table of their names."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"sha1": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    large = rows.where(F.col("size") >= MIN_REVISIT)
    largest = large.groupBy("sha1", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    repeated = largest.where("n > 1 and last is not null").select("sha1", "size", "last")
    rows = rows.join(repeated, ["sha1", "size"], "left")
    again = F.col("last").isNotNull() & (F.col("page_id") < F.col("last"))
    rows = rows.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    rows = rows.withColumn("refers_to", F.when(again, F.col("last")))
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    return stored(rows.mapInArrow(_writer(folder), "archive string"), "archives")


def chunks(archives: DataFrame, folder: str) -> DataFrame:
    """The chunked record table of archives."""
    return archives.repartition(archives.sparkSession.sparkContext.defaultParallelism * 4, "archive").mapInArrow(_read(folder), _CHUNK_ROW)


def records(pages: DataFrame) -> DataFrame:
    """Write pages and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = scratch(pages.sparkSession, "warc")
    read = chunks(write(pages, folder), folder).where("last")
    return read.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
