"""WARC archives: a writer with revisit records and a reader that salvages damaged archives.

Writing: payloads of at least ``min_revisit`` bytes are compared by SHA-256; the least
page_id holds the response, the others are revisit records that refer to it. Each record is
one gzip member. Spark's text writer commits the files, so any file system that Spark writes
to will do and a task that is lost and run again leaves no torn archive; its line separator
is an empty gzip member, which is a valid part of a gzip file.

Reading: each member or record is checked (gzip CRC, header, length, closing blank lines,
block digest). After a failed check the reader searches for the next member or version line
whose record passes all checks, goes on there, and reports the bytes between as a gap. Of a
member that fails, or holds a record that does, the records that pass their own checks are kept:
version lines are searched in what could be inflated, and the gap says how many were found.

An archive file is read whole by one task and inflated member by member; ``records_per_file`` bounds
those written here. Spark's reader takes files of up to 2 GB: larger ones must be split beforehand.

Edge cases: null html is an empty payload, a null url is no header; line breaks in a url are
percent-encoded; a null page_id is written as ``null`` and read back as null, it is only
referred to by nobody; repeated rows of the least page_id are all responses; an empty table
writes no records and gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, stored

MIN_REVISIT = 100
RECORDS_PER_FILE = 2000
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty gzip member.
SEPARATOR = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


# -- records ------------------------------------------------------------------------------


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit (refers_to given) has the HTTP headers only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    name = "null" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Damaged(ValueError):
    """reason, the records inside that pass their own checks, and where the bytes end that they were read from."""

    def __init__(self, reason: str, records: list[dict] | None = None, end: int = 0):
        super().__init__(reason)
        self.records, self.end = records or [], end


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """(fields, end) of the record that starts at ``at``; Damaged if any check fails."""
    if data[at : at + len(VERSION)] != VERSION:
        raise Damaged("no version line")
    split = data.find(b"\r\n\r\n", at)
    if split < 0:
        raise Damaged("no end of headers")
    fields = {}
    for line in data[at:split].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header without colon")
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        raise Damaged("no length or type")
    start, end = split + 4, split + 4 + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("no blank lines after the block")
    block = data[start:end]
    told = fields.get(b"warc-block-digest", b"")
    if told.startswith(b"sha256:") and hashlib.sha256(block).hexdigest().encode() != told[7:].lower():
        raise Damaged("block digest differs")
    return {"fields": fields, "block": block}, end + 4


def _inflate(data: memoryview, begin: int) -> tuple[bytes, int, str | None]:
    """(content, end, what is wrong) of the gzip member at ``begin``; its CRC and length are checked."""
    z, out, at, step = zlib.decompressobj(31), [], begin, 1 << 16
    while not z.eof:
        piece = data[at : at + step]
        if not len(piece):
            return b"".join(out), at, "the member is cut off"
        try:
            out.append(z.decompress(piece))
        except zlib.error as e:
            content, end = _inflated_until(data, begin, at + step)
            return content, end, f"gzip: {e}"
        at += len(piece)
    return b"".join(out), at - len(z.unused_data), None


def _inflated_until(data: memoryview, begin: int, end: int) -> tuple[bytes, int]:
    """What a member gives before it fails, to the last byte, and where it fails: ever smaller pieces, as a failing one gives nothing."""
    z, out, at = zlib.decompressobj(31), [], begin
    for step in (1 << 12, 64, 1):
        while at < min(end, len(data)):
            before = z.copy()
            try:
                out.append(z.decompress(data[at : at + step]))
            except zlib.error:
                z = before
                break
            at += step
    return b"".join(out), min(at + 1, len(data))


def _unit(data: bytes, view: memoryview, at: int) -> tuple[list[dict], int]:
    """(records, end) of the member or plain record at ``at``."""
    if data[at : at + 3] != MAGIC:
        record, end = parse_record(data, at)
        return [record], end
    content, end, wrong = _inflate(view, at)
    records, i = [], 0
    while i < len(content):
        try:
            record, i = parse_record(content, i)
            records.append(record)
        except Damaged as e:
            wrong = wrong or str(e)
            i = content.find(VERSION, i + 1)
            if i < 0:
                break
    if wrong:
        raise Damaged(wrong, records, end)
    return records, end


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict | str]]:
    """("record", start, end, record) and ("gap", start, end, reason) over a whole archive, in order.

    Records that are saved from a failed member have its gap's place in the file.
    """
    view, at, lost, why, saved = memoryview(data), 0, None, "", []
    inside: list[tuple[int, list[dict]]] = []  # (end, records) of failed members: a start before such an end may show its records again
    while at < len(data):
        known = [r for end, some in inside if at < end for r in some]
        try:
            records, end = _unit(data, view, at)
        except Damaged as e:
            if lost is None:
                lost, why = at, str(e)
            saved += [r for r in e.records if r not in known]
            if e.records:
                inside.append((e.end, e.records))
            found = _START.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if lost is not None:
            if all(r in known for r in records):  # nothing new; and a separator proves nothing about what comes before a real record
                at = end
                continue
            yield from _gap(lost, at, why, saved)
            lost, saved, inside = None, [], []
        for record in records:
            yield "record", at, end, record
        at = end
    if lost is not None:
        yield from _gap(lost, len(data), why, saved)


def _gap(start: int, end: int, why: str, saved: list[dict]) -> Iterator[tuple[str, int, int, dict | str]]:
    for record in saved:
        yield "record", start, end, record
    yield "gap", start, end, why + (f"; {len(saved)} records saved" if saved else "")


# -- tables -------------------------------------------------------------------------------


def _page(value: bytes | None) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", value or b"")
    return int(found[1]) if found else None


def with_revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, refers_to.

    Only ids and digests are compared; the table of revisits is joined back to the payloads, which are
    shuffled once where it is too large for Spark to broadcast.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    narrow = stored(rows.where(F.octet_length("payload") >= min_revisit).select("page_id", "digest"), "digests")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    later = narrow.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", "digest",
        F.col("first").alias("refers_to")).distinct()
    later = stored(later, "revisits").select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
    return rows.join(later, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select("page_id",
        "url", "payload", "digest", "refers_to")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
            yield pa.RecordBatch.from_arrays([pa.array([gzip_member(make_record(*row)) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)], pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Archives of all pages under path, a gzip member for each page."""
    members = with_revisits(pages, min_revisit).mapInArrow(_members, "member binary")
    # the cast keeps the bytes as they are
    text = members.select(F.col("member").cast("string").alias("value"))
    text.write.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile",
        records_per_file).text(path)


READ = "path string, start long, stop long, gap string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in READ.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows, size = [], 0
            for kind, start, stop, what in salvage(content.as_py() or b""):
                if kind == "gap":
                    rows.append((path, start, stop, what, *[None] * 7))
                else:
                    rows.append((path, start, stop, None, *_row(what)))
                    size += len(what["block"])
                if size > 1 << 23:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)


def _row(record: dict) -> tuple:
    """page_id .. payload of a record; size and digest are taken from the payload where there is one."""
    fields, block = record["fields"], record["block"]
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, uri = fields[b"warc-type"].decode(), fields.get(b"warc-target-uri")
    if kind == "revisit":
        size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        digest = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha256:").decode()
        payload, size = None, int(size[1]) if size else None
    else:
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    return _page(fields.get(b"warc-record-id")), uri and uri.decode(errors="replace"), kind, _page(fields.get(b"warc-refers-to")), size, digest, payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record and every gap of the archives under path, with its place in its file."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read, READ)


def records(found: DataFrame) -> DataFrame:
    return found.where("gap is null").drop("gap")


def gaps(found: DataFrame) -> DataFrame:
    """The quarantine log: path, start, stop and the reason of each byte range that was skipped."""
    return found.where("gap is not null").select("path", "start", "stop", F.col("gap").alias("reason"))


def round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """The records of pages' archives, written to the shared folder and read back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_revisit)
    return records(read_archives(pages.sparkSession, path))
