"""WARC archives: a writer and a sequential reader.

Every record is a gzip member of its own.  The writer gives records with equal
payloads one response (the smallest page_id) and revisits that name it; the
reader goes through an archive member by member with incremental decompression,
frames the block by Content-Length and verifies block and payload digests.

Reading holds one record and a read buffer, never an archive.  Archives are
written under a name of the task attempt and moved into place, so a retried
task replaces its own files.

Defined results: a null html is an empty payload; a null page_id stands in no
comparison (it revisits the smallest known page_id of its payload, and is a
response where all are null); rows that repeat the smallest page_id of a payload
are all responses; a null url is written as an empty target; records that are equal
in all have record ids of their own; an empty table writes no archive.  Of archives
made elsewhere every record is read, whatever its type, also without digests or page
ids; columns beside ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import scratch, settle

CRLF = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(value: str | None) -> str:
    """Header values hold no line ends."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value or "")


#: The hashes that digests are verified by; others are taken as they stand.
_HASHES = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}


def matches(claimed: str | None, data: bytes) -> bool:
    """Whether a digest header (algorithm:value, in base32 or hexadecimal) fits, or cannot be told."""
    name, _, value = (claimed or "").partition(":")
    if name.lower() not in _HASHES:
        return True
    own = _HASHES[name.lower()](data)
    return value.upper().rstrip("=") in (base64.b32encode(own.digest()).decode().rstrip("="), own.hexdigest().upper())


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           date: str, place: str = "", refers_to_url: str | None = None) -> bytes:
    """One record as a gzip member; a revisit has no payload but its digest and length.
    ``place`` (in the archives) tells equal records apart."""
    revisit = refers_to is not None
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % len(payload), b"", b""])
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest_of(payload)}|{place}")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {_one_line(url)}",
             "Content-Type: application/http; msgtype=response",
             f"WARC-Block-Digest: sha1:{digest_of(block)}",
             f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
             f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To-Target-URI: {_one_line(refers_to_url)}",
                  f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page-ID: {refers_to}"]
    head = "".join(x + "\r\n" for x in lines).encode() + b"Content-Length: %d\r\n\r\n" % len(block)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(CRLF * 2) + packer.flush()


def members(stream, size: int = 1 << 18) -> Iterator[Iterator[bytes]]:
    """For every gzip member of a stream, an iterator over its decompressed pieces.
    A member must be read to its end before the next."""
    rest = stream.read(size)
    while rest:
        unpacker = zlib.decompressobj(31)

        def pieces() -> Iterator[bytes]:
            nonlocal rest
            while True:
                out = unpacker.decompress(rest, size)
                if unpacker.eof:
                    rest = unpacker.unused_data or stream.read(size)
                    if out:
                        yield out
                    return
                rest = unpacker.unconsumed_tail
                if out:
                    yield out
                if not rest:
                    rest = stream.read(size)
                    if not rest:
                        raise ValueError("an archive ends inside a record")
        yield pieces()


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and verified block of every record."""
    for pieces in members(stream):
        held = b""
        for x in pieces:
            held += x
            if (at := held.find(CRLF * 2)) >= 0:
                break
        else:
            raise ValueError("a record without an end of its headers")
        first, *lines = held[:at].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        parts, have = [held[at + 4:]], len(held) - at - 4
        for x in pieces:
            parts.append(x)
            have += len(x)
        block = b"".join(parts)
        if block[length:] != CRLF * 2:
            raise ValueError("a record whose Content-Length does not match its block")
        block = block[:length]
        if not matches(headers.get("warc-block-digest"), block):
            raise ValueError("a record whose block digest does not match")
        yield headers, block


def page(headers: dict[str, str], block: bytes) -> tuple:
    """The fields of a record.  The payload of a record that carries a page by HTTP is what
    stands behind the HTTP headers, of other kinds (warcinfo, resource, metadata ...) the
    block; a revisit has none, and its digest is what its header says.  A payload digest,
    where there is one, is verified, except of a body sent in chunks."""
    kind = headers.get("warc-type", "")
    number = lambda k: int(headers[k]) if k in headers else None
    claimed = headers.get("warc-payload-digest")
    if kind == "revisit":
        payload, size = None, number("x-payload-length")
        digest = claimed.partition(":")[2] if claimed else None
    else:
        http, head = headers.get("content-type", "").lower().startswith("application/http"), b""
        head, _, payload = block.partition(CRLF * 2) if http else (b"", b"", block)
        chunked = re.search(rb"(?im)^transfer-encoding:.*chunked", head)
        if not chunked and not matches(claimed, payload):
            raise ValueError("a record whose payload digest does not match")
        size, digest = len(payload), digest_of(payload)
    return (number("x-page-id"), headers.get("warc-target-uri"), kind,
            number("x-refers-to-page-id"), size, digest, payload)


def _writer(folder: str, date: str, file_bytes: int):
    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        made: list[tuple[str, int]] = []
        out = trial = None
        size = count = 0

        def close() -> None:
            nonlocal out, size, count
            if out is not None:
                out.close()
                name = f"pages-{task.partitionId():07d}-{len(made):05d}.warc.gz"
                fs.move(trial, f"{root}/{name}")
                made.append((name, count))
            out, size, count = None, 0, 0

        for frame in frames:
            for i in range(frame.num_rows):
                page_id, url, html, refers, first_url = (c[i].as_py() for c in frame.columns)
                if out is None:
                    trial = f"{root}/.pages-{task.taskAttemptId()}-{len(made)}"
                    out = fs.open_output_stream(trial)
                place = f"{task.partitionId()}-{len(made)}-{count}"
                data = record(page_id, url, html or b"", refers, date, place, first_url)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
            ["file", "n_records"])
    return write


def write_warc(pages: DataFrame, folder: str, least: int = 0, file_bytes: int = 1 << 26,
               date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row below ``folder`` (a URI that every executor
    reaches); returns file, n_records.  Payloads of at least ``least`` bytes are
    written once.

    The response of a payload is a grouped minimum over (digest, page_id), which
    combines before its shuffle; the join back lets Spark split a hot payload."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    same = F.sha2(F.col("html"), 256)
    if least > 0:
        same = F.when(F.octet_length("html") >= least, same)
    rows = rows.withColumn("same", same)
    firsts = rows.where("same IS NOT NULL").groupBy("same").agg(
        F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")),
                    F.col("first"))
    linked = rows.join(firsts, "same", "left").select(
        "page_id", "url", F.encode("html", "UTF-8").alias("html"), refers.alias("refers_to"), "first_url")
    return settle(linked.mapInArrow(_writer(folder, date, file_bytes),
                                    "file string, n_records long"), "warc")


def _reader(folder: str, batch_bytes: int, with_payload: bool):
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        rows, size = [], 0
        for frame in frames:
            for name in frame.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for headers, block in records(stream):
                        row = page(headers, block)
                        rows.append(row if with_payload else (*row[:6], None))
                        size += len(row[6] or b"") * with_payload + 500
                        if size >= batch_bytes:
                            yield pack(rows)
                            rows, size = [], 0
        yield pack(rows)
    return read


def read_warc(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in a manifest (column ``file``)."""
    return files.select("file").repartition("file").mapInArrow(
        _reader(folder, 1 << 22, with_payload), RECORD)


def round_trip(pages: DataFrame, least: int = 0, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` to a new folder of the shared space and read them back."""
    folder = scratch(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    return read_warc(write_warc(pages, folder, least), folder, with_payload)
