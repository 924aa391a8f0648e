"""WARC archives of pages, and a reader that carries on after damage.

Every record is a gzip member of its own. Payloads that several pages share are
written once, in the response of the smallest page_id; the others are revisit
records that refer to it. The reader checks each member (CRC), each record's
framing and its digests. What fails is quarantined as a byte range with the reason,
and reading goes on at the end of the record if its frame is sound, otherwise at the
next gzip member that holds a record or the next version line.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.common import looked_up, map_arrow, tune

#: Shorter payloads are written again for every page.
LEAST_SHARED = 100
#: Compressed bytes after which an archive file is closed.
ARCHIVE_BYTES = 16 << 20
#: Longest header block of a record.
HEADER_BYTES = 1 << 16
#: Bytes given to inflate at a time.
_STEP = 1 << 16
#: Bytes of records handed on together.
_FLUSH = 8 << 20

# gzip's magic number and method, WARC's version line and profile.
_GZIP = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]+\.[0-9]+\r\n")
_VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty gzip member.
_EMPTY = bytes.fromhex("1f8b08000000000000ff03000000000000000000")

RECORDS = (
    "archive string, start long, stop long, kind string, reason string, record_type string,"
    " record_id string, page_id long, target_uri string, date string, refers_id string,"
    " payload_bytes long, payload_digest string, payload binary"
)
_FIELDS = [f.split()[0] for f in RECORDS.split(",")]


# --- writing -------------------------------------------------------------------------


def _header(fields: list[tuple[str, object]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None).encode()


def record(page: dict, date: str) -> bytes:
    """One WARC record of a planned page, uncompressed."""
    revisit = page["refers_id"] is not None
    payload = b"" if revisit else (page["payload"] or "").encode()
    http = b"HTTP/1.1 200 OK\r\n" + _header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", page["payload_bytes"])]
    )
    block = http + b"\r\n" + payload
    # a target is one line: anything that is no printable ASCII is percent-encoded
    uri, first = (quote(u, safe="".join(map(chr, range(33, 127)))) or None for u in (page["url"], page["first_url"] or ""))
    head = _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:uuid:{page['record_id']}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("X-Page-Id", page["page_id"]),
            ("WARC-Profile", _PROFILE if revisit else None),
            ("WARC-Refers-To", f"<urn:uuid:{page['refers_id']}>" if revisit else None),
            ("WARC-Refers-To-Target-URI", first if revisit else None),
            ("WARC-Payload-Digest", f"sha256:{page['digest']}"),
            ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """Gzip member ending in a zero byte: the high byte of the length is one below
    16 MiB, an empty member follows otherwise."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return packed if packed[-1] == 0 else packed + _EMPTY


def _digest_uuid(digest: str):
    """Record id of the one response that holds a shared payload."""
    return F.concat_ws("-", *[F.substr(digest, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, digest, payload_bytes, payload, record_id, refers_id, first_url of
    the record of each row; payload is null and refers_id set for revisits.

    Of rows with equal payloads of ``LEAST_SHARED`` bytes the one with the smallest
    page_id (none counts as greatest, then the lesser url) is the response. Where the
    row is repeated, one of its copies is.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).cast("long").alias("payload_bytes"),
        text.alias("payload"),
    )
    alike = (
        rows.where(F.col("payload_bytes") >= LEAST_SHARED)
        .groupBy("digest", "page_id", "url")
        .agg(F.count("*").alias("times"))
    )
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "times"))
    shared = (
        alike.groupBy("digest")
        .agg(F.sum("times").alias("weight"), least.alias("first"))
        .where("weight > 1")
    )
    known = looked_up(rows, shared, "digest", "weight", salt=["page_id", "url"])
    first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("url") == F.col("first.url"))
    own = known.withColumn("_response", F.col("first").isNull() | first)
    # copies of the first row are counted, and one of them is made the response
    several = F.coalesce(F.col("_response") & (F.col("first.times") > 1), F.lit(False))
    if not shared.where("first.times > 1").isEmpty():
        names = ["page_id", "url", "digest", "payload_bytes", "first"]
        copies = own.where(several).groupBy(*names).agg(F.min("payload").alias("payload"))
        copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("first.times").cast("int"))))
        copies = copies.withColumn("_response", F.col("_copy") == 1).select(*names, "payload", "_response")
        own = own.where(~several).select(*names, "payload", "_response").unionByName(copies)
    revisit = ~F.col("_response")
    return own.select(
        "page_id",
        "url",
        "digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(F.col("first").isNull() | revisit, F.uuid()).otherwise(_digest_uuid("digest")).alias("record_id"),
        F.when(revisit, _digest_uuid("digest")).alias("refers_id"),
        F.when(revisit, F.col("first.url")).alias("first_url"),
    )


def write(pages: DataFrame, path: str, created: datetime | None = None) -> None:
    """Write a record for each row (page_id, url, html) to archives under ``path``.

    Null html is empty, a null url leaves the target out, rows without page_id and
    repeated rows have a record each; further columns are not looked at. An empty table
    writes no record. Spark's text writer puts down the bytes, one archive a row, so
    files are committed like any output; their names end in .txt and readers know them
    by their content.
    """
    date = (created or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_members, size = [], 0
        for batch in batches:
            for page in batch.to_pylist():
                open_members.append(member(record(page, date)))
                size += len(open_members[-1])
                if size >= ARCHIVE_BYTES:
                    yield _archive(open_members)
                    open_members, size = [], 0
        if open_members:
            yield _archive(open_members)

    tune(pages.sparkSession)
    archives = planned(pages).mapInArrow(run, "archive binary")
    # the line end that the writer adds is the last member's closing zero
    archives.select(F.col("archive").cast("string")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", 1
    ).text(path)


def _archive(members: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(members)[:-1]], pa.binary())})


# --- reading -------------------------------------------------------------------------


class Damage(Exception):
    """A failed check, and where to go on if the record's frame is sound."""

    def __init__(self, reason: str, resume: int | None = None):
        super().__init__(reason)
        self.reason, self.resume = reason, resume


def inflate(data: memoryview, at: int, limit: int | None = None) -> tuple[bytes, int]:
    """Content of the gzip member at ``at`` and its end; of the first bytes only, if
    there is a limit."""
    worker, out, fed = zlib.decompressobj(31), [], at
    try:
        while not worker.eof and fed < len(data):
            step = min(_STEP, limit or _STEP)
            out.append(worker.decompress(data[fed : fed + step]))
            fed += step
            if limit:
                return b"".join(out), fed
    except zlib.error as e:
        raise Damage(f"gzip: {e}", _sound_end(data, at)) from None
    if not worker.eof:
        raise Damage("gzip: cut off")
    return b"".join(out), min(fed, len(data)) - len(worker.unused_data)


def _sound_end(data: memoryview, at: int) -> int | None:
    """End of a member that only fails its checks, if another one or nothing follows."""
    if data[at + 3] != 0:
        return None
    worker, fed = zlib.decompressobj(-15), at + 10
    try:
        while not worker.eof and fed < len(data):
            worker.decompress(data[fed : fed + _STEP])
            fed += _STEP
    except zlib.error:
        return None
    end = min(fed, len(data)) - len(worker.unused_data) + 8
    sound = worker.eof and (end == len(data) or bytes(data[end : end + 3]) == _GZIP)
    return end if sound else None


def _matches(digest: str, data: bytes) -> bool:
    """Whether the data has the digest; those of unknown algorithms are not judged."""
    name, _, value = digest.partition(":")
    name = name.lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(name, data, usedforsecurity=False).digest()
    return value.lower() == found.hex() or value.rstrip("=").upper() == base64.b32encode(found).decode().rstrip("=")


def parse(data: bytes | memoryview, at: int) -> tuple[dict, int]:
    """The uncompressed record at ``at`` and where it ends."""
    head = bytes(data[at : at + HEADER_BYTES])
    version, end = _VERSION.match(head), head.find(b"\r\n\r\n")
    if not version:
        raise Damage("no version line")
    if end < 0:
        raise Damage("header without end")
    fields: dict[str, str] = {}
    name = None
    for line in head[version.end() : end].decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or "\r" in line or "\n" in line:
            raise Damage("malformed header")
        name = name.strip().lower()
        fields[name] = value.strip()
    missing = [n for n in ("warc-type", "warc-record-id", "content-length") if n not in fields]
    if missing or not fields["content-length"].isdecimal():
        raise Damage(f"no {missing[0] if missing else 'content-length'}")
    start, length = at + end + 4, int(fields["content-length"])
    stop = start + length
    if stop > len(data):
        raise Damage("record cut off")
    if bytes(data[stop : stop + 4]) != b"\r\n\r\n":
        raise Damage("no record end after content-length")
    block = bytes(data[start:stop])
    payload, http = block, fields.get("content-type", "").startswith("application/http")
    if http:
        gap = block.find(b"\r\n\r\n")
        payload = block[gap + 4 :] if gap >= 0 else b""
    if "warc-block-digest" in fields and not _matches(fields["warc-block-digest"], block):
        raise Damage("block digest", stop + 4)
    full = fields["warc-type"] not in ("revisit", "continuation") and "warc-truncated" not in fields
    if full and "warc-payload-digest" in fields and not _matches(fields["warc-payload-digest"], payload):
        raise Damage("payload digest", stop + 4)
    return {"fields": fields, "payload": payload}, stop + 4


def _next(data: memoryview, at: int) -> int:
    """Next place where a record may start."""
    for found in _START.finditer(data, at):
        if found.group() != _GZIP:
            return found.start()
        try:
            content, _ = inflate(data, found.start(), 512)
        except Damage:
            continue
        if content.startswith(b"WARC/"[: max(1, len(content))]) and content:
            return found.start()
    return len(data)


def salvage(data: bytes | memoryview, packed: bool = True) -> Iterator[tuple[int, int, dict | str]]:
    """(start, stop, record) of every sound record, (start, stop, reason) of every
    quarantined range, in order; together they cover all bytes but zero padding."""
    data = memoryview(data)
    at = 0
    while at < len(data):
        start = at
        try:
            if packed and bytes(data[at : at + 3]) == _GZIP:
                content, at = inflate(data, at)
                for _, _, found in salvage(content, packed=False):
                    yield start, at, found if isinstance(found, dict) else f"in a sound member: {found}"
            elif data[at] == 0:
                while at < len(data) and data[at] == 0:
                    at += 1
            else:
                found, at = parse(data, at)
                yield start, at, found
        except Damage as damage:
            at = damage.resume or _next(data, start + 1)
            yield start, at, damage.reason


def _row(archive: str, start: int, stop: int, found: dict | str) -> dict:
    row = dict.fromkeys(_FIELDS) | {"archive": archive, "start": start, "stop": stop}
    if isinstance(found, str):
        return row | {"kind": "gap", "reason": found}
    fields, payload = found["fields"], found["payload"]
    page = fields.get("x-page-id", "")
    own = fields["warc-type"] != "revisit"
    return row | {
        "kind": "record",
        "record_type": fields["warc-type"],
        "record_id": fields["warc-record-id"],
        "page_id": int(page) if re.fullmatch(r"-?[0-9]{1,18}", page) else None,
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "refers_id": fields.get("warc-refers-to"),
        "payload_bytes": len(payload) if own else None,
        "payload_digest": hashlib.sha256(payload).hexdigest() if own else None,
        "payload": payload if own else None,
    }


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``, plain or by members.

    ``kind`` is ``record`` or ``gap``. A gap has its archive, byte range and reason,
    a record its range, headers of note and, unless it is a revisit, its payload.
    Undamaged files have no gap, empty ones no row. A file is read whole by one task
    (2 GB at most, as Spark's reader has it).
    """

    def make():
        def step(batch: pa.RecordBatch):
            for archive, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows, size = [], 0
                for start, stop, found in salvage(memoryview(content.as_buffer())):
                    rows.append(_row(archive, start, stop, found))
                    size += 500 + (rows[-1]["payload_bytes"] or 0)
                    if size >= _FLUSH:
                        yield _columns(rows)
                        rows, size = [], 0
                if rows:
                    yield _columns(rows)

        return step

    files = tune(spark).read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    return map_arrow(files.select("path", "content"), make, RECORDS)


def _columns(rows: list[dict]) -> dict:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return {
        name: pa.array([r[name] for r in rows], kinds[kind])
        for name, kind in (f.split() for f in RECORDS.split(","))
    }


def resolve(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record.

    A revisit has size and digest of the payload in the response it refers to, and
    that one's page_id; all null if the response was not recovered.
    """
    records = found.where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_id"
    )
    revisits = records.where("record_type = 'revisit'").groupBy("refers_id").agg(F.count("*").alias("weight"))
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_id"))
        .agg(F.min(F.struct("page_id", "payload_bytes", "payload_digest")).alias("origin"))
        .join(revisits, "refers_id")
    )
    known = looked_up(records, responses, "refers_id", "weight", salt=["record_id"])
    own = F.col("record_type") != "revisit"
    return known.select(
        "page_id",
        *[F.when(own, F.col(c)).otherwise(F.col(f"origin.{c}")).alias(c) for c in ("payload_bytes", "payload_digest")],
        "record_type",
        F.when(~own, F.col("origin.page_id")).alias("refers_to"),
    )
