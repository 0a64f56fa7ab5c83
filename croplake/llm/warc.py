"""WARC archives from pages and back, through a table of payload chunks.

A payload becomes rows (record, chunk number, bytes, running SHA-1): no row, message or write holds a whole payload
beyond the input's own cell, and a writer streams the rows of a record in order. Writers check every chunk against
the running digest. Each task writes one archive under a name of its own and moves it to its final name when it is
complete, so that a task that runs again writes the same file again. Readers stream the archives in the same pieces.

Payloads that are equal and have at least ``least`` bytes are stored once: the record with the largest page_id is a
response, the others revisit it (of rows with one page_id, one is the response). Null html is an empty payload; a
null page_id is a page without a number, smaller than any other; a null url is left out of the header. An empty
table gives one empty table and no archive.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CHUNK_BYTES = 1 << 16
#: Equal payloads of at least so many bytes are stored once.
LEAST_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunks(pages: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """(record, page_id, url, chunk, bytes, running, total): the chunk table; an empty payload has one empty chunk.

    ``record`` numbers the row by its contents; ``running`` is the SHA-1 of the payload up to the chunk's end,
    ``total`` the payload's length in the last chunk and null before.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for page, url, html in zip(batch.column("page_id"), batch.column("url"), common.as_text(batch.column("html")), strict=True):
                data = html.as_buffer()
                page, url = page.as_py(), url.as_py()
                record = _record(page, url, data)
                sha = hashlib.sha1()
                for no in range(max(1, -(-len(data) // size))):
                    piece = data[no * size : (no + 1) * size]
                    sha.update(piece)
                    end = (no + 1) * size >= len(data)
                    rows.append((record, page, url, no, piece.to_pybytes(), sha.copy().digest(), len(data) if end else None))
                    held += len(piece)
                    if held >= 64 * size:
                        yield dict(zip(_CHUNK, zip(*rows, strict=True), strict=True))
                        rows, held = [], 0
            if rows:
                yield dict(zip(_CHUNK, zip(*rows, strict=True), strict=True))

    return common.over_batches(pages.select("page_id", "url", "html"), "record binary, page_id long, url string, chunk int, bytes binary, running binary, total long", work)


_CHUNK = ("record", "page_id", "url", "chunk", "bytes", "running", "total")


def _record(page: int | None, url: str | None, data: pa.Buffer) -> bytes:
    """128 bits: two of 10**10 records are the same by chance once in some 10**18 runs."""
    h = xxhash.xxh3_128(repr((page, url)).encode("utf-8", "surrogatepass"))
    h.update(data)
    return h.digest()


def roles(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(record, running, total, copies, response, once, refers_to): what each record is, with its whole digest and length; ``copies`` rows of the table are this record."""
    ends = chunks(pages).where(F.col("total").isNotNull()).groupBy("record", "page_id", "total", "running").agg(F.count("*").alias("copies"))
    ends = common.written(ends, "records")
    first = ends.where(F.col("total") >= least).groupBy("running", "total").agg(F.max(F.struct("page_id", "record")).alias("first"))
    return ends.join(first, ["running", "total"], "left").select(
        "record", "running", "total", "copies", (F.col("first").isNull() | (F.col("first.record") == F.col("record"))).alias("response"),
        (F.col("total") >= least).alias("once"), F.col("first.page_id").alias("refers_to"),
    )


def write(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as gzipped WARC files below ``path``; gives (file, records, bytes)."""
    role = roles(pages, least).select("record", F.lit(-1).alias("chunk"), F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("bytes"), "running", "total", "copies", "response", "once", "refers_to")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("copies", "long"), ("response", "boolean"), ("once", "boolean"), ("refers_to", "long"))]
    rows = chunks(pages).select("record", "chunk", "page_id", "url", "bytes", "running", "total", *nothing).union(role)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        writer: _Writer | None = None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(batch.num_columns)), strict=True):
                if writer is None:
                    writer = _Writer(path)
                writer.take(*(x.as_py() for x in row))
        if writer is not None:
            yield writer.close()

    # every record's role comes first, then its chunks in order
    dealt = rows.repartition("record").sortWithinPartitions("record", "chunk")
    return common.written(common.over_batches(dealt, "file string, records long, bytes long", work), "archives")


def _clean(url: str) -> str:
    """A header line holds no control characters, spaces or non-ASCII."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)


def _name(page: int | None) -> str:
    return "urn:page:" + ("none" if page is None else str(page))


class _Writer:
    """One archive: rows of a record in order, its role first."""

    def __init__(self, path: str) -> None:
        self.fs, self.path = pafs.FileSystem.from_uri(path)
        self.fs.create_dir(self.path)
        self.part = f"{self.path}/.part-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.names, self.records, self.written = hashlib.sha1(), 0, 0
        self.record: bytes | None = None

    def take(self, record, chunk, page, url, data, running, total, copies, response, once, refers_to) -> None:
        if chunk < 0:  # the role: length and digest of the whole payload are known before its first chunk
            self.record, self.next = record, 0
            self.total, self.digest, self.copies, self.once, self.refers_to = total, running, copies, once, refers_to
            self.whole = response or not once
            return
        if record != self.record:
            raise ValueError("a chunk without its record")
        if chunk < self.next:
            return  # the same row of the table again; it is counted in copies
        if chunk != self.next:
            raise ValueError("a chunk is missing")
        self.next += 1
        if chunk == 0:
            self.sha, self.small = hashlib.sha1(), []
            packer = self._begin(page, url, self.whole)
            self.packer = packer if self.whole else self._end(packer)
        self.sha.update(data)
        if self.sha.digest() != running:
            raise ValueError("a chunk is damaged")
        if self.whole:
            self._put(self.packer.compress(data))
            if not self.once and self.copies > 1:
                self.small.append(data)  # of less than the least bytes for storing once
        if total is None:
            return
        if running != self.digest:
            raise ValueError("a record isn't what its role says")
        if self.whole:
            self._end(self.packer)
        for _ in range(self.copies - 1):
            packer = self._begin(page, url, not self.once)
            for piece in self.small:
                self._put(packer.compress(piece))
            self._end(packer)

    def _begin(self, page, url, whole):
        """A record's headers; its payload follows if it is stored whole."""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {self.total}\r\n\r\n".encode()
        head = ["WARC/1.1", f"WARC-Type: {'response' if whole else 'revisit'}", f"WARC-Record-ID: <{_name(page)}>", "WARC-Date: 1970-01-01T00:00:00Z"]
        if url is not None:
            head.append(f"WARC-Target-URI: {_clean(url)}")
        head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(self.digest).decode()}", "Content-Type: application/http; msgtype=response"]
        if not whole:
            head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_name(self.refers_to)}>"]
        head.append(f"Content-Length: {len(http) + (self.total if whole else 0)}")
        packer = zlib.compressobj(4, wbits=31)
        self._put(packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http))
        self.names.update(repr((self.record, self.records)).encode())
        self.records += 1
        return packer

    def _end(self, packer) -> None:
        self._put(packer.compress(b"\r\n\r\n") + packer.flush())

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.written += len(data)

    def close(self) -> dict:
        self.out.close()
        file = f"{self.path}/{self.names.hexdigest()}.warc.gz"  # named by what it holds
        self.fs.move(self.part, file)
        return {"file": [file], "records": [self.records], "bytes": [self.written]}


_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)")


def _plain(raw: BinaryIO, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The bytes of a file of gzip members, in pieces."""
    unpacker = zlib.decompressobj(wbits=31)
    rest = b""
    while rest or (rest := raw.read(size)):
        if unpacker.eof:
            unpacker = zlib.decompressobj(wbits=31)
        piece = unpacker.decompress(rest, size)
        rest = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
        if piece:
            yield piece


class _Reader:
    """Records of a stream of bytes; payloads pass through in pieces."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, b""

    def more(self) -> bool:
        piece = next(self.pieces, b"")
        self.held += piece
        return bool(piece)

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends within a header")
                return None
        got, self.held = self.held[:at], self.held[at + len(mark) :]
        return got

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("an archive ends within a record")
            got, self.held = self.held[:n], self.held[n:]
            n -= len(got)
            yield got


def records(raw: BinaryIO) -> Iterator[tuple[dict[str, str], bytes, Iterator[bytes]]]:
    """(WARC header by lower-case name, HTTP header, payload pieces) of each record; take the pieces before going on."""
    reader = _Reader(_plain(raw))
    while (head := reader.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        header = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
        http = reader.until(b"\r\n\r\n") or b""
        pieces = reader.take(int(header["content-length"]) - len(http) - 4)
        yield header, http, pieces
        for _ in pieces:
            pass
        if b"".join(reader.take(4)) != b"\r\n\r\n":
            raise ValueError("a record has the wrong length")


def _page(name: str) -> int | None:
    number = name.strip("<>").removeprefix("urn:page:")
    return None if number == "none" else int(number)


def read(spark: SparkSession, path: str, archives: DataFrame) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A response's length and digest are those of the bytes read; its digest must agree with its header. A revisit's
    are those its headers name for the full payload.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        fs, _ = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(file, compression=None) as raw:
                    for header, http, pieces in records(raw):
                        digest = header["warc-payload-digest"].removeprefix("sha1:")
                        if header["warc-type"] == "response":
                            sha, size = hashlib.sha1(), 0
                            for piece in pieces:
                                sha.update(piece)
                                size += len(piece)
                            if base64.b32encode(sha.digest()).decode() != digest:
                                raise ValueError(f"the payload of {header['warc-record-id']} is damaged")
                        else:
                            size = int(_LENGTH.search(http)[1])
                        refers = header.get("warc-refers-to")
                        rows.append((_page(header["warc-record-id"]), size, digest, header["warc-type"], _page(refers) if refers else None, header.get("warc-target-uri")))
                        if len(rows) == 5000:
                            yield dict(zip(_READ, zip(*rows, strict=True), strict=True))
                            rows = []
                if rows:
                    yield dict(zip(_READ, zip(*rows, strict=True), strict=True))

    # a task for each archive
    tasks = max(1, archives.count())
    return common.over_batches(archives.select("file").repartition(tasks, "file"), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string", work)


_READ = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.work_path(spark, "warc")
    if ":" not in path:
        path = "file://" + os.path.abspath(path)
    elif path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return read(spark, path, write(common.table(spark, sf_dir, "pages"), path)).select(*_READ[:5])


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, octet_length(encode(h)) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, (i // 4) * 5 + 1, 5))::INTEGER >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to
FROM q
"""
