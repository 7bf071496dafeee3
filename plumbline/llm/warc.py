"""Web archives: writing records, and a splittable reader of gzipped WARC files.

Each record is a gzip member of its own.  The reader's tasks get byte ranges of the files, not files: a
task looks for the three bytes that begin a member, takes a place for a member only if what follows
decompresses to a record's first line, and owns the records that begin inside its range, reading
beyond the range's end to finish the last.  From one record to the next it follows the members' ends.
Files are reached through the file system that their URI names, from within tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import file_system, quoted, text_of, written
from plumbline.session import scratch_path

# The formats' marks.
_MAGIC, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_URN = "urn:x-page:"
#: Bytes of a range, and of a read.
RANGE, READ = 16 << 20, 1 << 20


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight groups of five hex digits, four letters each."""
    hexed = F.sha1(data)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(hexed, group * 5 + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def records(pages: DataFrame, id_column: str, url_column: str, payload_column: str, least: int = 0) -> DataFrame:
    """Columns ``page_id, url, payload, digest, refers_to``: what is to be written for each page.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id holds the payload
    and the others refer to it; smaller ones all hold theirs.  A null payload is an empty one; null ids
    are below all others, and refer to nothing if there is no other.  Rows that share the largest id all hold it.
    """
    payload = text_of(payload_column).cast("binary")
    rows = pages.select(quoted(id_column).cast("long").alias("page_id"), quoted(url_column).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    shared = rows.select("page_id", "digest", F.octet_length("payload").alias("n")).where(F.col("n") >= least)
    holders = shared.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.max("page_id").alias("holder"))
    holders = written(holders.where("rows > 1 AND holder IS NOT NULL").select(F.col("digest").alias("d"), "holder"), "holders")
    joined = rows.join(holders, F.col("digest") == F.col("d"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _member(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = f"{_URN}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    block = http + (payload if refers_to is None else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + gzip.flush()


def write(rows: DataFrame, directory: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes ``records`` to one gzipped file per partition; columns ``path, bytes, records`` of the files.

    A task writes under a name of its own and renames when done, so a repeated task replaces its file.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, folder = file_system(directory)
        system.create_dir(folder, recursive=True)
        own, final = f"{folder}/.{context.taskAttemptId()}-{uuid.uuid4().hex}", f"part-{context.partitionId():06d}.warc.gz"
        count, size = 0, 0
        out = None
        for batch in batches:
            for k in range(len(batch)):
                member = _member(*(c[k].as_py() for c in batch.columns), date)
                out = out or system.open_output_stream(own)
                out.write(member)
                count, size = count + 1, size + len(member)
        if out is not None:
            out.close()
            system.move(own, f"{folder}/{final}")
            yield pa.RecordBatch.from_pydict({"path": [f"{directory}/{final}"], "bytes": [size], "records": [count]})

    return written(rows.mapInArrow(put, "path string, bytes long, records long"), "manifest")


class _File:
    """Bytes of a file from any place, by reads of a fixed size."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()
        self.at, self.held = 0, b""

    def bytes(self, at: int) -> memoryview:
        """What is held from here on, at least three bytes unless the file ends; empty at its end."""
        if not self.at <= at or at + 3 > self.at + len(self.held):
            self.at, self.held = at, self.file.read_at(min(READ, max(0, self.size - at)), at) if at < self.size else b""
        return memoryview(self.held)[at - self.at :]


def _record(source: _File, at: int) -> tuple[bytes, int] | None:
    """The record of the member that begins here and where the member ends; None if none does."""
    flat = zlib.decompressobj(31)
    parts, place = [], at
    checked = False
    try:
        while not flat.eof:
            data = source.bytes(place)
            if not len(data):
                return None
            parts.append(flat.decompress(data))
            place += len(data) - len(flat.unused_data)
            if not checked and sum(map(len, parts)) >= len(_VERSION):
                checked = True
                if not b"".join(parts).startswith(_VERSION):
                    return None
    except zlib.error:
        return None
    return (b"".join(parts), place) if checked else None


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _page(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{_URN}(-?\d+)>", value or "")
    return int(found[1]) if found else None


_ROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("valid", pa.bool_()), ("path", pa.string()), ("offset", pa.int64())]
)


def _row(record: bytes, path: str, offset: int) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length, digest = int(_headers(http).get("content-length", 0)), warc.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = warc.get("warc-type")
    if kind != "response":
        return (_page(warc.get("warc-record-id")), warc.get("warc-target-uri"), kind, _page(warc.get("warc-refers-to")), None, length, digest, True, path, offset)
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    valid = own == digest and len(payload) == length
    return (_page(warc.get("warc-record-id")), warc.get("warc-target-uri"), kind, None, payload, len(payload), own, valid, path, offset)


def _scan(path: str, start: int, end: int) -> Iterator[tuple]:
    source = _File(path)
    at = start
    while at < end:
        data = source.bytes(at)
        if len(data) < 3:
            return
        found = bytes(data).find(_MAGIC)
        if found < 0:
            at += len(data) - 2  # a mark may lie across two reads
            continue
        at += found
        if at >= end:
            return
        record = _record(source, at)
        while record is not None:
            yield _row(record[0], path, at)
            at = record[1]
            record = _record(source, at) if at < end and bytes(source.bytes(at)[:3]) == _MAGIC else None
            if record is None:
                at -= 1
        at += 1


def read(files: DataFrame, span: int = RANGE) -> DataFrame:
    """The records of archives, from a table of their ``path`` and ``bytes``.

    Columns: the ids of the page and of the page it refers to, if they are numbers, the URL, ``record_type``, the
    ``payload`` (null for revisits), the full payload's ``payload_bytes`` and ``payload_digest`` (as found for
    responses, as recorded for others), ``valid`` (false if what was found isn't what was recorded), and the record's
    place.  Bytes that are no record are passed over.  An archive without bytes has no records.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROW, strict=True)], schema=_ROW)

        for ranges in batches:
            for path, start, end in zip(*(c.to_pylist() for c in ranges.columns), strict=True):
                for row in _scan(path, start, end):
                    rows.append(row)
                    held += len(row[4] or b"")
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()

    starts = F.explode(F.expr(f"sequence(0L, (bytes - 1) div {span})")).alias("k")
    ranges = files.where("bytes > 0").select("path", "bytes", starts)
    ranges = ranges.select("path", (F.col("k") * span).alias("start"), F.least((F.col("k") + 1) * span, F.col("bytes")).alias("end"))
    n = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, valid boolean, path string, offset long"
    return ranges.repartition(n, "path", "start").mapInArrow(scan, schema)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """Columns ``path, bytes`` of the archives that a path or pattern names; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
    return found.select("path", F.col("length").alias("bytes"))


def round_trip(pages: DataFrame, span: int = RANGE) -> DataFrame:
    """Columns ``page_id, payload_bytes, payload_digest, record_type, refers_to`` of pages, archived and read again."""
    directory = scratch_path(pages.sparkSession, "warc")
    rows = read(write(records(pages, "page_id", "url", "html"), directory), span)
    checked = F.when(F.col("valid"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record in "), "path")))
    return rows.select("page_id", "payload_bytes", checked.cast("string").alias("payload_digest"), "record_type", "refers_to")
