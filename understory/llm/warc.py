"""WARC archives of pages: writing with duplicate revisits and segments, and reassembly on reading.

Writing: a page is a `response` record whose HTTP body is in chunked transfer framing, or
a `revisit` that points to the page of least id with an equal payload.  A block longer
than a segment goes on in `continuation` records with the origin's id, segment numbers
and, in the last, the total length.  Records are rows of a text sink whose separator is
the blank line that ends a record, gzip-compressed, so archives go to any file system
that Spark writes to, and its committer makes retried tasks safe.

Reading: rows come back in file order and are joined with the same separator, which
restores the bytes; records are cut by Content-Length.  Segments are grouped by origin
id, ordered by number, held against the total length and the digest, and the chunked
framing is decoded.  A reader task holds one record at a time, never a file.

Defined results: a null page has an empty payload; null ids are kept as null and are the
response of their payload only where no page has an id; rows of the same id and payload
as the response are responses; short payloads are all responses; an empty table writes
no archive and reads no row.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from understory.llm.common import map_arrow, saved, shared_folder

MIN_REVISIT_BYTES = 100
SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 8 << 10
#: Duplicate groups that are broadcast at most (about 100 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 100_000
_END = "\r\n\r\n"
_EPOCH = "1970-01-01T00:00:00Z"

RECORDS = "origin string, number long, total long, page_id long, payload_digest string, payload_bytes long, record_type string, refers_to long, block binary"


def _cut(data: bytes, size: int) -> list[bytes]:
    """Pieces of about `size` bytes that end between UTF-8 characters."""
    pieces, at = [], 0
    while at < len(data):
        end = min(len(data), at + size)
        while at + 1 < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        pieces.append(data[at:end])
        at = end
    return pieces


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in _cut(payload, size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        if len(parts[-1]) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is not as long as its size says")
        at = end + 4 + size


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = [b"WARC/1.1"] + [f"{k}: {v}".encode() for k, v in fields if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, unique: str, segment: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of a page, without the blank line that ends each."""
    name = f"<urn:uuid:{uuid.UUID(hashlib.md5(unique.encode()).hexdigest())}>"
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    else:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload)
    pieces = _cut(block, segment)
    for i, piece in enumerate(pieces):
        segments = [("WARC-Segment-Number", i + 1)] if len(pieces) > 1 else []
        if i:
            own = f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{unique}/{i}'.encode()).hexdigest())}>"
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Segment-Origin-ID", name)]
            fields += [*segments, ("WARC-Segment-Total-Length", len(block) if i == len(pieces) - 1 else None)]
        else:
            fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Page-ID", page_id)]
            fields += [("Refers-To-Page-ID", refers_to), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to is not None else None), *segments]
        fields += [("WARC-Target-URI", target), ("WARC-Date", _EPOCH), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(piece))]
        yield _head(fields) + piece


def decide(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(digest, first): the least page_id of each payload of at least min_bytes that several rows have."""
    sized = pages.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    narrow = sized.where(F.octet_length("payload") >= min_bytes).select(F.sha2("payload", 256).alias("digest"), "page_id")
    found = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return found.where("n > 1 AND first IS NOT NULL").select("digest", "first")


def write(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, segment: int = SEGMENT_BYTES) -> None:
    """Write pages (page_id, url, html) as gzip-compressed WARC files in the folder path."""
    groups = saved(decide(pages, min_bytes), "revisits")
    few = groups.count() <= BROADCAST_ROWS
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("uid", F.monotonically_increasing_id())
    rows = rows.join(F.broadcast(groups) if few else groups, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "payload", "digest", refers.alias("refers_to"), "uid")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[bytes] = []
            size = 0
            for r in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5).to_pylist(), strict=True):
                for record in records(*r[:5], f"{r[0]}/{r[3]}/{r[5]}", segment):
                    made.append(record)
                    size += len(record)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()).cast(pa.string(), safe=False)], names=["value"])
                    made, size = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()).cast(pa.string(), safe=False)], names=["value"])

    map_arrow(rows, make, "value string").write.option("lineSep", _END).option("compression", "gzip").text(path)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records whose bytes come as rows cut at blank lines.

    Each row and its separator are the next bytes of the archives.  A blank line may
    also be cut within a block, or across the end of one; lengths alone decide.
    """
    end = _END.encode()
    head, parts, need, fields = b"", [], 0, None
    for batch in batches:
        for row in batch.column(0).to_pylist():
            piece = row + end
            while piece:
                if fields is None:
                    head = (head + piece).lstrip(b"\r\n")
                    at = head.find(end)
                    if at < 0:
                        break
                    lines, piece, head = head[:at].split(b"\r\n"), head[at + len(end) :], b""
                    if not lines[0].startswith(b"WARC/"):
                        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
                    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
                    parts, need = [], int(fields["content-length"]) + len(end)
                else:
                    parts.append(piece[:need])
                    piece, need = piece[len(parts[-1]) :], need - len(parts[-1])
                    if not need:
                        yield fields, b"".join(parts)[: -len(end)]
                        fields = None
    if fields is not None or head:
        raise ValueError("an archive ends within a record")


def _payload(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?i)\r\ntransfer-encoding:\s*chunked", head) else body


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _response(fields: dict[str, str], block: bytes) -> tuple:
    digest = hashlib.sha256(payload := _payload(block)).hexdigest()
    if (said := fields.get("warc-payload-digest")) and said.partition(":")[2] != digest:
        raise ValueError("a payload differs from its digest")
    return digest, len(payload)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("page_id", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("block", pa.binary())])
    rows, size = [], 0
    for fields, block in _stream(batches):
        kind, number = fields["warc-type"], _number(fields.get("warc-segment-number"))
        page, digest, length, keep = _number(fields.get("page-id")), fields.get("warc-payload-digest", "").partition(":")[2] or None, None, None
        if number is not None:
            keep = block
        elif kind == "revisit":
            found = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", block)
            length = int(found[1]) if found else None
        else:
            digest, length = _response(fields, block)
        origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
        rows.append((origin, number, _number(fields.get("warc-segment-total-length")), page, digest, length, kind, _number(fields.get("refers-to-page-id")), keep))
        size += len(keep or b"") + 200
        if size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole responses from segments that come ordered by origin and number."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("segments", pa.int64())])
    current: list[dict] = []

    def whole(parts: list[dict]) -> tuple:
        block = b"".join(p["block"] for p in parts)
        if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block):
            raise ValueError(f"record {parts[0]['origin']} lacks segments, or its total length differs")
        digest, length = _response({"warc-payload-digest": f"sha256:{parts[0]['payload_digest']}"}, block)
        return parts[0]["page_id"], length, digest, parts[0]["record_type"], None, len(parts)

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if current and current[0]["origin"] != r["origin"]:
                rows.append(whole(current))
                current = []
            current.append(r)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(whole(current), schema, strict=True)], schema=schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, segments of each record set in a folder of archives."""
    lines = spark.read.option("lineSep", _END).text(path).select(F.col("value").cast("binary").alias("value"))
    found = saved(map_arrow(lines, _parse, RECORDS), "records")
    whole = found.where("number IS NULL").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.lit(1).cast("long").alias("segments"))
    parts = found.where("number IS NOT NULL").repartition("origin").sortWithinPartitions("origin", "number")
    joined = map_arrow(parts, _reassemble, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, segments long")
    return whole.unionByName(joined)


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    path = f"{shared_folder(spark)}/understory/warc-{uuid.uuid4().hex}"
    write(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return read(spark, path).drop("segments")


#: DuckDB SQL for op5's contract columns.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
  CASE WHEN f.first IS NULL OR f.first = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
