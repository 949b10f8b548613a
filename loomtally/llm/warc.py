"""WARC archives of pages, and a salvage reader.

Writing. Of pages with equal payloads the one with the smallest id becomes a response record,
the others revisit records that refer to it. A payload is known by a 256-bit digest, and only
ids and digests move to find the first of each. Records are put together inside tasks, each a
gzip member by default, and gathered to archives of about `ARCHIVE_BYTES`; a row of Spark's text
writer is an archive, whose last bytes are the writer's line separator. So any store that Spark
writes to will do, and a lost task leaves nothing behind.

Reading. Each archive is read front to back. A member's checksum, a record's length, its closing
lines and its digests are checked. Where a check fails, the bytes go to quarantine: if the end
of the damaged part is known, up to there, else up to the next place from which a member or a
record that starts with a version line passes all checks. Quarantined gaps are rows of the
result too, with their bytes' places and the first check that failed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtally.llm.tables import durable
from loomtally.operators.durable import new_path

ARCHIVE_BYTES = 8_000_000
# An archive is one row of the reader, which holds it in memory.
READ_BYTES = 1_000_000
MAX_HEADER = 1_000_000
FED_BYTES = 16_384
# Copies of the table of first pages, so that a payload that very many pages share is split.
COPIES = 16

VERSION = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
MEMBER = b"\x1f\x8b\x08"
CLOSING = b"\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page `refers_to`, with its closing lines."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
    }
    if url is not None:
        # Printable ASCII as it is, all else as percent codes: a header line can't be broken up.
        headers["WARC-Target-URI"] = urllib.parse.quote(url, safe="".join(map(chr, range(33, 127))), errors="replace")
    if refers_to is not None:
        headers["WARC-Refers-To"] = _name(refers_to)
        headers["WARC-Profile"] = SAME_PAYLOAD
    headers["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + CLOSING


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _with_first_pages(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `html`, `refers_to` (NULL for responses)."""
    key = F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("string").alias("html"))
    keyed = pages.select("page_id", key.alias("key"))
    shared = keyed.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    copies = durable(shared.select("key", "first")).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    split = keyed.withColumn("copy", F.pmod(F.xxhash64("page_id"), F.lit(COPIES)).cast("int"))
    again = split.join(copies, ["key", "copy"]).where("page_id IS NULL OR page_id > first")
    again = durable(again.select(F.coalesce("page_id", F.lit(0)).alias("id"), F.col("page_id").isNull().alias("no_id"), "key", "first").distinct())
    named = pages.withColumns({"key": key, "id": F.coalesce("page_id", F.lit(0)), "no_id": F.col("page_id").isNull()})
    return named.join(again, ["id", "no_id", "key"], "left").select("page_id", "url", "html", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, compressed: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of `pages` (`page_id`, `url`, `html`) as files in a new folder.

    A record each row: the payload is the html in UTF-8, empty for NULL. Of equal payloads, empty
    ones too, the smallest page_id (an integer, else it is an error) is the response. Rows that
    agree in page_id and payload are written alike. A row without page_id is never referred to;
    it revisits a page that has one, and is a response if none has. A NULL url leaves its header
    out. Other columns, whatever their names, are not looked at. An archive is closed when it
    reaches `archive_bytes`; a record is never split.
    """
    # A member ends in its length, whose last byte is 0 up to 16 MB; an empty one adds no record.
    separator, closing = (b"\0", member(b"")) if compressed else (CLOSING, b"")

    def build(batches):
        parts, size = [], 0

        def archive() -> pa.RecordBatch:
            data = b"".join(parts)
            if not data.endswith(separator):
                data += closing
            return pa.RecordBatch.from_arrays([pa.array([data[: -len(separator)]], pa.binary())], names=["archive"])

        for batch in batches:
            for page_id, url, html, first in zip(*(batch[c] for c in ("page_id", "url", "html", "refers_to"))):
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                one = record(page_id.as_py(), url.as_py(), payload, first.as_py())
                parts.append(member(one) if compressed else one)
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield archive()
                    parts, size = [], 0
        if parts:
            yield archive()

    archives = _with_first_pages(pages).mapInArrow(build, "archive binary")
    writer = archives.select(F.col("archive").cast("string").alias("value")).write
    writer.option("lineSep", separator.decode()).option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


class Damaged(Exception):
    """A failed check; `end` is where the damaged part surely ends, if that is known."""

    def __init__(self, problem: str, end: int | None = None) -> None:
        super().__init__(problem)
        self.problem, self.end = problem, end


def _headers(lines: bytes) -> dict[str, str]:
    """Fields by lower-case name; a line that starts with a blank goes on with the one before."""
    unfolded = re.sub(rb"\r\n[ \t]+", b" ", lines).decode("utf-8", "replace")
    split = (line.partition(":") for line in unfolded.split("\r\n"))
    return {name.strip().lower(): value.strip() for name, colon, value in split if colon}


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _agrees(field: str | None, data: bytes) -> bool:
    kind, _, value = (field or "").partition(":")
    return kind.lower() != "sha1" or value.upper() == digest(data)


def _number(value: str | None) -> int | None:
    return int(value) if re.fullmatch(r"[0-9]{1,18}", value or "") else None


def read_record(data: bytes, at: int) -> tuple[int, dict]:
    """Where the record that starts at `at` ends, and what it holds."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    stop = data.find(CLOSING, version.end() - 2, at + MAX_HEADER)
    if stop < 0:
        raise Damaged("headers without end")
    fields = _headers(data[version.end() : stop])
    length = _number(fields.get("content-length"))
    if length is None:
        raise Damaged("no content length")
    start, end = stop + 4, stop + 4 + length
    if end + 4 > len(data):
        raise Damaged("cut off")
    if data[end : end + 4] != CLOSING:
        raise Damaged("wrong content length")
    block, end = data[start:end], end + 4
    if not _agrees(fields.get("warc-block-digest"), block):
        raise Damaged("block digest differs", end)
    revisit, payload, size = fields.get("warc-type") == "revisit", block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(CLOSING)
        size = len(payload)
        if revisit:
            size = _number(_headers(http).get("content-length"))
    if not revisit and not _agrees(fields.get("warc-payload-digest"), payload):
        raise Damaged("payload digest differs", end)
    kind, _, known = fields.get("warc-payload-digest", "").partition(":")
    return end, {
        "record_type": fields.get("warc-type"), "page_id": _page(fields.get("warc-record-id")),
        "refers_to": _page(fields.get("warc-refers-to")), "url": fields.get("warc-target-uri"),
        "payload_digest": known.upper() if kind.lower() == "sha1" else digest(payload),
        "payload_bytes": size, "payload": None if revisit else payload,
    }


def read_member(data: bytes, at: int) -> tuple[int, list[dict]]:
    """Where the gzip member that starts at `at` ends, and the records in it."""
    unpack, out, fed = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof and fed < len(data):
            out.append(unpack.decompress(data[fed : fed + FED_BYTES]))
            fed += FED_BYTES
    except zlib.error as error:
        raise Damaged("member fails its checks") from error
    if not unpack.eof:
        raise Damaged("member cut off")
    end = min(fed, len(data)) - len(unpack.unused_data)
    raw, place, records = b"".join(out), 0, []
    while place < len(raw):
        try:
            place, one = read_record(raw, place)
        except Damaged as error:
            raise Damaged(error.problem, end) from error
        records.append(one)
    return end, records


def salvaged(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive, in order, with `start` and `end` in its bytes."""
    at, gap, problem = 0, None, None
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                end, records = read_member(data, at)
            else:
                end, one = read_record(data, at)
                records = [one]
        except Damaged as error:
            if gap is None:
                gap, problem = at, error.problem
            following = START.search(data, at + 1)
            at = error.end or (following.start() if following else len(data))
            continue
        if gap is not None:
            yield {"start": gap, "end": at, "problem": problem}
            gap = None
        for one in records:
            yield {"start": at, "end": end, **one}
        at = end
    if gap is not None:
        yield {"start": gap, "end": len(data), "problem": problem}


FIELDS = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("problem", pa.string()),
    ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])
SCHEMA = (
    "path string, start long, end long, problem string, record_type string, page_id long, refers_to long,"
    " url string, payload_digest string, payload_bytes long, payload binary"
)


def salvage(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record and every quarantined gap of the archives in a folder, in any order.

    A record: its archive (`path`) and place in it (`start`, `end` of its member, if it is one),
    `record_type`, `page_id` and `refers_to` (NULL where the name isn't a page's), `url`,
    `payload_digest`, `payload_bytes` (both of the full payload, for revisits as their headers
    say) and, with `payloads`, the bytes, NULL for revisits. A gap: `path`, `start`, `end` and
    `problem`, which is NULL for records. Empty archives give nothing. Plain records and members
    may stand in one archive, and members may hold several records or none. An archive is read
    in one task; `write_archives` bounds their size.
    """

    def scan(batches):
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                rows, size = [], 0
                for found in salvaged(content.as_buffer().to_pybytes()):
                    if not payloads:
                        found["payload"] = None
                    rows.append({"path": path, **found})
                    size += 500 + len(found.get("payload") or b"")
                    if size >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, FIELDS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, FIELDS)

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(scan, SCHEMA)


def round_trip(pages: DataFrame, compressed: bool = True) -> DataFrame:
    """`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to` read back from new archives."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    write_archives(pages, folder, compressed)
    return salvage(spark, folder, payloads=False).where("problem IS NULL").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
