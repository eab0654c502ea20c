"""Web archives: pages to segmented records with chunked bodies, and back.

Writing cuts a long block into segments: the record itself holds the first, continuation records the others. Reading takes records as they
stand in the files, gathers the segments of each origin in order of their numbers, checks the total length, and decodes the chunked
transfer framing. A payload that an earlier page already has is written as a revisit without a body.

A record's length comes from its Content-Length: text that looks like the start of a record inside a body splits nothing. Null and empty
bodies are payloads of no bytes, and equal to each other. Rows that repeat a page id and its payload each get a record of the same kind. A
null page id is written as an empty one and is never referred to while its payload has another page. Other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tether.session import stored

# Fixed values of the format.
VERSION = b"WARC/1.1"
END = b"\r\n"
BETWEEN = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"
ID = "urn:page:"

SEGMENT_BYTES, CHUNK_BYTES = 8192, 4096
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("refers_to", pa.string()),
        ("digest", pa.string()),
        ("origin", pa.string()),
        ("number", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
        ("reason", pa.string()),
    ]
)
RECORD_TYPES = "record_id string, type string, refers_to string, digest string, origin string, number long, total long, block binary, reason string"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer framing; extensions of chunk sizes and trailers are passed over."""
    out, at = [], 0
    while True:
        line_end = body.index(END, at)
        size = int(body[at:line_end].split(b";")[0].strip(), 16)
        if not size:
            return b"".join(out)
        start = line_end + 2
        if body[start + size : start + size + 2] != END:
            raise ValueError("a chunk does not end where its size says")
        out.append(body[start : start + size])
        at = start + size + 2


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in fields if value is not None], b"", b""]
    return END.join(lines)


def records_of(page: str, row: int, url: str | None, payload: bytes, first: str | None, segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """Records of one page. ``first`` is the page that has the same payload, if another one stands for it."""
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    own = f"<{ID}{page}:{row}>"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    named = [("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if first is not None:
        return [_head([("WARC-Type", "revisit"), *named, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID}{first}>"), ("Content-Length", 0)])]
    block = HTTP_HEAD + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = []
    for i, part in enumerate(parts):
        number = None if len(parts) == 1 else i + 1
        if i == 0:
            fields = [("WARC-Type", "response"), *named, ("Content-Type", "application/http; msgtype=response")]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{ID}{page}:{row}:{number}>"), *common, ("WARC-Segment-Origin-ID", own)]
        if i and i == len(parts) - 1:
            fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_head([*fields, ("WARC-Segment-Number", number), ("Content-Length", len(part))]) + part)
    return out


def repeated_payloads(pages: DataFrame, key: str, html: str, min_bytes: int = 0) -> DataFrame:
    """``(key, sha1, first)`` of pages whose payload of at least ``min_bytes`` bytes stands in a page with a smaller key."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    small = pages.select(F.col(key).alias("key"), F.sha1(payload).alias("sha1"), F.length(payload).alias("size")).where(F.col("size") >= min_bytes)
    first = small.groupBy("sha1", "size").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    return small.join(first, ["sha1", "size"]).where("key is null or key > first").select("key", "sha1", "first").distinct()


def write_archive(
    pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, key: str = "page_id", html: str = "html", url: str = "url"
) -> None:
    """Write ``pages`` as gzip archives under ``path``, one file for each partition."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    given = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    repeats = repeated_payloads(pages, key, html, min_bytes).select(F.col("key").alias("again"), F.col("sha1").alias("again_sha1"), "first")
    rows = given.join(repeats, F.col("key").eqNullSafe(F.col("again")) & (F.col("sha1") == F.col("again_sha1")), "left").select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("page"), F.monotonically_increasing_id().alias("row"), "url", "payload", F.col("first").cast("string").alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, row, link, body, first in zip(*[c.to_pylist() for c in batch.columns]):
                yield pa.RecordBatch.from_pydict({"value": pa.array(records_of(page, row, link, body, first, segment_bytes), pa.binary())})

    records = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", BETWEEN).option("compression", "gzip").text(path)


def parsed(head: bytes, block: bytes) -> dict:
    """A record's fields that reading needs."""
    fields = {}
    for line in head.split(END):
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")

    def number(name: bytes) -> int | None:
        value = fields.get(name, "")
        return int(value) if value.isdigit() else None

    return {
        "record_id": fields.get(b"warc-record-id"),
        "type": fields.get(b"warc-type"),
        "refers_to": fields.get(b"warc-refers-to"),
        "digest": fields.get(b"warc-payload-digest", "").removeprefix("sha1:") or None,
        "origin": fields.get(b"warc-segment-origin-id"),
        "number": number(b"warc-segment-number"),
        "total": number(b"warc-segment-total-length"),
        "block": block,
        "reason": None,
    }


def records_in(pieces: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """Records of ``(file, piece)`` in file order, where pieces are what stands between possible starts of records.

    A piece shorter than its record says is continued by the next one: the start between them was part of the body.
    """
    between = BETWEEN.encode() + VERSION + END

    def record(whole: bytes) -> tuple[dict | None, bytes]:
        """The record at the start of ``whole``, None if more of it must follow, and what comes after its body."""
        head, gap, rest = whole.partition(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head)
        if not length:
            return {"reason": "no length"}, b""
        size = int(length[1])
        if len(rest) < size or not gap:
            return None, b""
        return parsed(head, rest[:size]), rest[size:]

    file, held = None, None
    for name, piece in pieces:
        if held is not None and name == file:
            held += between + piece
        else:
            if held is not None:
                yield {"reason": "cut short"}
            held = piece.removeprefix(VERSION + END)
        file = name
        while held is not None:
            found, after = record(held)
            if found is None:
                break
            yield found
            # A start that began inside the body and ended behind it was taken for the one that follows it.
            held = after.removeprefix(between) if after.startswith(between) else None
    if held is not None:
        yield {"reason": "cut short"}


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Records as they stand in archives: ``(record_id, type, refers_to, digest, origin, number, total, block, reason)``.

    ``reason`` says why a record could not be read. Archives should be compressed: each is then read by one task, in order. In a plain file
    that is split, a body that holds the start of a record right at a split cannot be put together and is ``cut short``.
    """
    raw = spark.read.option("lineSep", BETWEEN + VERSION.decode() + "\r\n").text(paths)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                yield from zip(batch.column("file").to_pylist(), batch.column("value").to_pylist())

        rows, held = [], 0
        for row in records_in(each()):
            rows.append(row)
            held += len(row.get("block") or b"")
            if held > 4 << 20 or len(rows) > 10_000:
                yield pa.RecordBatch.from_pylist(rows, RECORD_SCHEMA)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, RECORD_SCHEMA)

    return pieces.mapInArrow(run, RECORD_TYPES)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records: ``(record_id, type, refers_to, digest, block, reason)``.

    Segments are gathered by origin: no more than one record at a time. A record is rejected if a segment is missing, twice there or of another
    length than the last one states.
    """
    keep = ["record_id", "type", "refers_to", "digest", "block", "reason"]
    whole = records.where("number is null").select(*keep)
    segments = records.where("number is not null").withColumn("origin", F.coalesce("origin", "record_id"))
    part = F.struct("number", "block", "total", "type", "refers_to", "digest")
    gathered = segments.groupBy("origin").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.length(p["block"]))
    in_order = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))
    last = F.element_at("parts", -1)
    reason = F.when(~in_order, "segments missing").when(last["total"].isNull(), "no total length").when(last["total"] != size, "wrong total length")
    first = F.element_at("parts", 1)
    # In hexadecimal, as arrays of text can be joined in one pass.
    joined_block = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), ""))
    joined = gathered.select(
        F.col("origin").alias("record_id"), first["type"].alias("type"), first["refers_to"].alias("refers_to"), first["digest"].alias("digest"), joined_block.alias("block"), reason.alias("reason")
    )
    return whole.unionByName(joined)


def payloads(records: DataFrame) -> DataFrame:
    """``(record_id, type, refers_to, digest, payload, reason)`` of whole response and revisit records; revisits have no payload.

    The payload is checked against the digest its record states.
    """
    schema = "record_id string, type string, refers_to string, digest string, payload binary, reason string"

    def payload_of(kind: str | None, stated: str | None, block: bytes | None) -> tuple[bytes | None, str | None]:
        if kind != "response":
            return None, None
        head, _, body = block.partition(b"\r\n\r\n")
        try:
            body = dechunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked", head) else body
        except ValueError:
            return None, "broken chunks"
        return (body, None) if stated in (None, digest(body)) else (None, "wrong digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if c != "block"]
            columns = {c: batch.column(c) for c in names}
            reasons = columns["reason"].to_pylist()
            rows = zip(columns["type"].to_pylist(), columns["digest"].to_pylist(), batch.column("block").to_pylist(), reasons)
            found = [(None, why) if why else payload_of(kind, stated, block) for kind, stated, block, why in rows]
            columns["payload"] = pa.array([p for p, _ in found], pa.binary())
            columns["reason"] = pa.array([why for _, why in found], pa.string())
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in ("record_id", "type", "refers_to", "digest", "payload", "reason")})

    return records.where("type in ('response', 'revisit') or reason is not null").mapInArrow(run, schema)


def page_records(found: DataFrame, key_type: str = "long", key: str = "page_id") -> DataFrame:
    """``(key, payload_bytes, payload_digest, record_type, refers_to)`` of the pages in ``payloads``; a revisit has its response's length.

    Records that could not be read are left out; they carry a reason there. Stores the records without their payloads.
    """

    def page(column: str) -> Column:
        return F.nullif(F.regexp_extract(column, rf"^<{ID}([^:>]*)", 1), F.lit("")).cast(key_type)

    light = found.select(page("record_id").alias("key"), "type", page("refers_to").alias("refers_to"), "digest", F.length("payload").cast("long").alias("size"), "reason")
    rows = stored(light, "records").where("reason is null").drop("reason")
    responses = rows.where("type = 'response'").groupBy(F.col("key").alias("of"), F.col("digest").alias("of_digest")).agg(F.max("size").alias("of_size"))
    revisits = rows.where("type = 'revisit'")
    resolved = revisits.join(responses, (F.col("refers_to") == F.col("of")) & (F.col("digest") == F.col("of_digest")), "left").withColumn("size", F.col("of_size"))
    both = rows.where("type = 'response'").unionByName(resolved.select(*rows.columns))
    return both.select(F.col("key").alias(key), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
