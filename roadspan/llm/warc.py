"""WARC archives: a writer that keeps equal payloads once, and a reader that salvages.

The writer groups payloads by digest; of equal ones the record with the smallest id holds the
payload, the others are revisits that point to it. Only digests and ids are shuffled. Tasks
join records to chunks of bounded size, and Spark's own writer commits them as files that hold
nothing but records: plain ones, or gzip members of one record each.

The reader takes an archive as bytes. A record that fails a check (header, length, the empty
lines behind it, digests, or the checksum of its gzip member) is not trusted, nor its length:
the search goes on behind its first byte for the next member or version line that begins a
valid record. What lies between is reported as a quarantined gap with its place and reason.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspan.llm.common import BROADCAST_ROWS, join_with_hot_keys, scratch_path, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A chunk of records is closed at this size; a file holds so many chunks.
CHUNK_BYTES = 8 << 20
CHUNKS_PER_FILE = 2
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
NAME = "urn:page:"

START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
LINE = re.compile(rb"WARC/1\.[01]\r\n")
FIELD = re.compile(rb"([!-9;-~]++):[\x20\t]*+([^\r\n]*+(?:\r\n[\x20\t][^\r\n]*+)*+)\r\n")
# More fields than this are no header, so that a place that looks like a record costs little.
MOST_FIELDS = 100
FEED = 1 << 16
PEEK = 1 << 10


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(text: str) -> str:
    """Text that stays on one header line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in text or "\n" in text else text


def build_record(
    page_id: int | None, uri: str | None, payload: bytes, date: str, refers_to: int | None = None, revisit: bool = False
) -> bytes:
    """A response record with the payload, or a revisit record without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{NAME}{'none' if page_id is None else page_id}>"),
        ("WARC-Date", date),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", _line(uri)))
    if revisit:
        fields.append(("WARC-Profile", REVISIT_PROFILE))
        fields.append(("WARC-Refers-To", f"<{NAME}{'none' if refers_to is None else refers_to}>"))
    fields += [
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode("utf-8", "surrogatepass")
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """The record as a gzip member of its own."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write(
    pages: DataFrame, path: str | None = None, least: int = 0, gzip: bool = False, date: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url",
) -> str:
    """Write a record per row to archives under ``path``; returns the path.

    Payloads are texts in UTF-8, null ones are empty. Of equal payloads of at least ``least``
    bytes, the row with the smallest id is a response and the others revisit it, rows without
    an id last; repeated rows with that smallest id are responses all. Shorter payloads are
    responses. A null ``uri`` leaves its field out. No table rows give no record.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"), F.sha1(payload).alias("sha1")
    )
    groups = (
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("sha1")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    groups = stored(groups, "equal-payloads")
    if groups.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(groups), "sha1", "left")
    else:
        rows = join_with_hot_keys(rows, groups, "sha1", "copies", pages.count())
    # A group without any id has no row to refer to; all its rows are responses.
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    last = b"\0" if gzip else b"\n"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            data = b"".join(held)
            if not data.endswith(last):
                # The length at a member's end has a zero as its highest byte, if not over 16 MB.
                data += member(VERSION + b"WARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
            # The writer puts the last byte behind each chunk.
            return pa.RecordBatch.from_pydict({"data": pa.array([data[:-1]], pa.binary())})

        for batch in batches:
            for at in range(batch.num_rows):
                id, uri, payload, first, again = (column[at].as_py() for column in batch.columns)
                record = build_record(id, uri, bytes(payload), date, first, again)
                held.append(member(record) if gzip else record)
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()

    chunks = rows.select("id", "uri", "payload", "first", revisit.alias("revisit")).mapInArrow(of, "data binary")
    (
        chunks.select(F.col("data").cast("string").alias("value"))
        .write.option("lineSep", last.decode())
        .option("maxRecordsPerFile", CHUNKS_PER_FILE)
        .text(path)
    )
    return path


@dataclass
class Record:
    """A record that passed its checks, or, with a reason, a quarantined gap."""

    start: int
    end: int
    fields: dict[str, str]
    block: bytes = b""
    reason: str | None = None


def _checked(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """(end, fields, block) of the record at a place, or what is wrong with it."""
    line = LINE.match(data, at)
    if not line:
        return "no version line"
    fields: dict[str, str] = {}
    at = line.end()
    while (found := FIELD.match(data, at)) and len(fields) < MOST_FIELDS:
        name = found[1].decode("latin-1").lower()
        # A second one tells of a header that was cut and runs on in another.
        if name in fields and name != "warc-concurrent-to":
            return "repeated field"
        fields[name] = found[2].decode("utf-8", "replace")
        at = found.end()
    if not fields or data[at : at + 2] != b"\r\n":
        return "broken header"
    begin = at + 2
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16):
        return "no length"
    end = begin + int(length)
    if end + 4 > len(data):
        return "cut off"
    if data[end : end + 4] != b"\r\n\r\n":
        return "wrong length"
    block = data[begin:end]
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", payload_of(fields, block))):
        kind, _, value = fields.get(name, "").partition(":")
        if kind.lower() == "sha1" and part is not None and value.upper() != digest(part):
            return "wrong digest"
    return end + 4, fields, block


def payload_of(fields: dict[str, str], block: bytes) -> bytes | None:
    """The payload within a block; None where the record does not hold it."""
    if fields.get("warc-type") == "revisit":
        return None
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _unpacked(data: bytes, at: int) -> tuple[int, bytes] | str:
    """(end, content) of the gzip member at a place, if it holds records, or what is wrong with it."""
    unpack, found, place = zlib.decompressobj(31), [], at
    view = memoryview(data)
    try:
        # A few bytes tell whether it is worth while to unpack the rest.
        head = unpack.decompress(view[at : at + PEEK], len(VERSION))
        if not head.startswith(b"WARC/1."):
            return "no record in member"
        found.append(head)
        place = at + PEEK
        found.append(unpack.decompress(unpack.unconsumed_tail))
        while not unpack.eof:
            if place >= len(data):
                return "cut off member"
            found.append(unpack.decompress(view[place : place + FEED]))
            place += FEED
    except zlib.error as wrong:
        return f"broken member ({str(wrong).rpartition(': ')[2]})"
    return min(place, len(data)) - len(unpack.unused_data), b"".join(found)


def salvage(data: bytes) -> Iterator[Record]:
    """All records of an archive that can be read, and the gaps between them, in their order."""
    at, lost, why = 0, None, ""
    while at < len(data):
        held: list[Record] = []
        if data[at : at + 2] == b"\x1f\x8b":
            got = _unpacked(data, at)
            if not isinstance(got, str):
                end, content = got
                inside, got = 0, ""
                while inside < len(content) and not isinstance(got := _checked(content, inside), str):
                    inside = got[0]
                    held.append(Record(at, end, got[1], got[2]))
                got = (end,) if inside >= len(content) else got
        else:
            got = _checked(data, at)
            if not isinstance(got, str):
                held = [Record(at, got[0], got[1], got[2])]
        if isinstance(got, str):
            lost, why = (at, got) if lost is None else (lost, why)
            following = START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if lost is not None:
            yield Record(lost, at, {}, reason=why)
            lost = None
        yield from held
        at = got[0]
    if lost is not None:
        yield Record(lost, len(data), {}, reason=why)


def _number(name: str | None) -> int | None:
    found = re.fullmatch(rf"<{NAME}([+-]?[0-9]+)>", name or "")
    return int(found[1]) if found else None


COLUMNS = {
    "archive": pa.string(), "start": pa.int64(), "end": pa.int64(), "reason": pa.string(), "record_type": pa.string(),
    "page_id": pa.int64(), "uri": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "refers_to": pa.int64(), "payload": pa.binary(),
}
SCHEMA = (
    "archive string, start long, end long, reason string, record_type string, page_id long, uri string,"
    " payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _row(archive: str, r: Record, with_payload: bool) -> tuple:
    if r.reason is not None:
        return archive, r.start, r.end, r.reason, *[None] * 7
    f, payload = r.fields, payload_of(r.fields, r.block)
    if payload is not None:
        size, name = len(payload), digest(payload)
    else:
        told = re.search(rb"(?im)^Content-Length:[\x20\t]*([0-9]{1,15})\r?$", r.block.partition(b"\r\n\r\n")[0])
        size = int(told[1]) if told else None
        name = f.get("warc-payload-digest", "").rpartition(":")[2].upper() or None
    return (
        archive, r.start, r.end, None, f.get("warc-type"), _number(f.get("warc-record-id")), f.get("warc-target-uri"),
        size, name, _number(f.get("warc-refers-to")), payload if with_payload else None,
    )


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(archive, start, end, reason, record_type, page_id, uri, payload_bytes, payload_digest, refers_to,
    payload) of all archives under ``path``, plain or gzip, damaged or not.

    Rows with a ``reason`` are quarantined gaps: the bytes ``start`` to ``end`` of the archive
    belong to no valid record, all else of them is null. Size and digest of a revisit are those
    of the payload it stands for, as its headers tell. An empty archive gives no row. An
    archive is read by one task, so archives should be of bounded size, as ``write`` makes them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {name: pa.array(values, kind) for (name, kind), values in zip(COLUMNS.items(), zip(*rows))}
            )

        for batch in batches:
            for at in range(batch.num_rows):
                archive, rows, size = batch.column("path")[at].as_py(), [], 0
                for r in salvage(batch.column("content")[at].as_py()):
                    rows.append(_row(archive, r, with_payload))
                    size += 200 + len(r.block) * with_payload
                    if size >= CHUNK_BYTES:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)

    return files.mapInArrow(of, SCHEMA)


def records(archived: DataFrame) -> DataFrame:
    """The records of pages among what was read."""
    return archived.filter(F.col("reason").isNull() & F.col("record_type").isin("response", "revisit")).drop("reason")


def gaps(archived: DataFrame) -> DataFrame:
    """(archive, start, end, reason): the quarantined byte gaps."""
    return archived.filter(F.col("reason").isNotNull()).select("archive", "start", "end", "reason")
