"""Web archives: writing pages as WARC records, and a splittable reader.

Each record is a gzip member of its own. Readers' tasks get byte ranges of the
archives: a task scans its range for the gzip magic, takes a candidate for a member
only if it decodes to a whole WARC record, and then owns every record that starts
inside its range, however far the last one reaches. No index and no cooperation
between tasks is needed, and one large archive is read by many tasks.

Writers name files by task attempt and report them in a written table; only files in
that table are read, so a lost or repeated task leaves no record twice.

Edge cases: a null html is an empty payload; a null page id is written as ``null`` and
read back as null; a null url leaves out the target; line ends in a url become spaces.
Payloads are compared by SHA-1 and length, as the revisit profile does. Equal rows
(same id, same payload) are all responses. Bytes that are no valid member are passed
over. A payload that itself holds an uncompressed gzip archive could be taken for
members only where a range starts inside it; text payloads (UTF-8) cannot.
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
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import keep, shared_folder

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Compressed bytes after which a writer starts a new archive, and bytes of a reader's range.
FILE_BYTES, RANGE_BYTES = 256 << 20, 8 << 20
_READ = 1 << 18


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", uri))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP head of the page but no payload."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest32(payload)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += payload if kind == "response" else b""
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *head]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row; the files written, as (path, bytes, records).

    ``pages`` has page_id, url and html. Of rows with equal payloads of at least
    ``min_bytes`` the largest page id is the response, the others revisit it.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    # One row per payload and task reaches this shuffle, a hot payload too.
    first = rows.groupBy("digest", "size").agg(F.max("page_id").alias("response"))
    rows = rows.join(first, ["digest", "size"])
    again = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.select("page_id", "url", "html", F.when(again, F.col("response")).alias("refers_to"), again.alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in batches:
            ids, urls, htmls, refers, agains = batch.columns
            for i in range(batch.num_rows):
                if out is None:
                    fs, base = _open(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, count = fs.open_output_stream(f"{base}/{name}", compression=None), 0
                payload = (htmls[i].as_py() or "").encode()
                kind = "revisit" if agains[i].as_py() else "response"
                out.write(_member(record(kind, ids[i].as_py(), urls[i].as_py(), payload, refers[i].as_py())))
                count += 1
                if out.tell() >= file_bytes:
                    done.append((f"{folder}/{name}", out.tell(), count))
                    out.close()
                    out = None
        if out is not None:
            done.append((f"{folder}/{name}", out.tell(), count))
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "bytes", "records"])

    return keep(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-files")


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """The archives in a folder as (path, bytes), for ``read_archives``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


class _Source:
    """Reads of a file at given places, a block at a time."""

    def __init__(self, uri: str, size: int):
        fs, path = _open(uri)
        self.file, self.size, self.at, self.block = fs.open_input_file(path), size, 0, b""

    def read(self, at: int) -> bytes:
        """Some bytes from ``at`` on; none at the end."""
        if not self.at <= at < self.at + len(self.block):
            self.file.seek(at)
            self.at, self.block = at, self.file.read(min(_READ, max(0, self.size - at)))
        return self.block[at - self.at :]


def parse_member(source: _Source, at: int) -> tuple[dict, bytes, int] | None:
    """(headers, block, place behind) of the record whose member starts at ``at``, or None.

    The header is decoded first, however long it is; a candidate whose first bytes are not a
    WARC header costs one block. Then the whole member must decode, with its check sum, to the
    length that the header gives.
    """
    unpack, data, head, here, looked = zlib.decompressobj(31), bytearray(), None, at, 0
    while not unpack.eof:
        raw = source.read(here)
        if not raw:
            return None
        here += len(raw)
        try:
            data += unpack.decompress(raw)
        except zlib.error:
            return None
        if head is None:
            if not data.startswith(b"WARC/"[: len(data)]):
                return None
            end = data.find(b"\r\n\r\n", max(0, looked - 3))
            if end < 0:
                looked = len(data)
                continue
            lines = data[:end].decode("utf-8", "replace").split("\r\n")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            if not {"warc-type", "warc-record-id", "content-length"} <= head.keys() or not head["content-length"].isdigit():
                return None
            body = end + 4
    if head is None or len(data) != body + int(head["content-length"]) + 4:
        return None
    return head, bytes(data[body:-4]), here - len(unpack.unused_data)


def records_in(uri: str, size: int, start: int, end: int) -> Iterator[tuple[dict, bytes, int]]:
    """(headers, block, place) of the records whose members start in [start, end)."""
    source, at, known = _Source(uri, size), start, False
    while at < end:
        if not known:
            # Bytes in front of the first member belong to a record of the range before.
            raw = source.read(at)
            hit = raw.find(MAGIC)
            if hit < 0:
                if at + len(raw) >= size:
                    return
                # The magic may lie across two blocks.
                at += max(1, len(raw) - 2)
                source.block = b""
                continue
            at += hit
            if at >= end:
                return
        got = parse_member(source, at)
        if got is None:
            at, known = at + 1, False
            continue
        yield got[0], got[1], at
        at, known = got[2], True


READ = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, path string, place long"


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, payload: bool = False) -> DataFrame:
    """A row per response or revisit record of the archives (path, bytes).

    The digest and length of a response are computed from its payload; those of a
    revisit stand in its headers. ``payload``: also return the payload (null in revisits).
    """
    pieces = files.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(range_bytes))).alias("start"))
    count = files.select(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    schema = READ + (", payload binary" if payload else "")

    def number(x: str | None) -> int | None:
        found = re.search(r"urn:page:(-?\d+)", x or "")
        return int(found[1]) if found else None

    def rows(path: str, size: int, start: int) -> Iterator[tuple]:
        for head, block, place in records_in(path, size, start, min(start + range_bytes, size)):
            kind = head["warc-type"]
            if kind in ("response", "revisit"):
                http, _, body = block.partition(b"\r\n\r\n")
                said = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                length = len(body) if kind == "response" else int(said[1]) if said else None
                sha = digest32(body) if kind == "response" else head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                row = (number(head["warc-record-id"]), kind, number(head.get("warc-refers-to")), length, sha, path, place)
                yield (*row, body if kind == "response" else None) if payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        fields = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])
        for batch in batches:
            for piece in batch.to_pylist():
                held: list[tuple] = []
                for row in rows(piece["path"], piece["bytes"], piece["start"]):
                    held.append(row)
                    if len(held) >= (64 if payload else 4096):
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), fields, strict=True)], schema=fields)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), fields, strict=True)], schema=fields)

    # As many partitions as ranges: their rows are tiny, their work is not.
    return pieces.repartition(int(count)).mapInArrow(run, schema)
