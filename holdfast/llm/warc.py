"""WARC archives: records written by Spark, read back, and segments put together again."""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate, column, expand
from holdfast.session import scratch_path, store

LEAST_REVISIT_BYTES = 100
SEGMENT_CHARS = 16_384  # of a record's block; longer blocks go on in continuation records
CHUNK_CHARS = 4_096  # of a chunk of the transfer coding
FILE_RECORDS = 2_048  # so that one archive file stays within a task's memory
DATE = "2024-01-01T00:00:00Z"  # of all records: pages carry no time
END = "\r\n\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = (
    "Content-Length", "Content-Type", "WARC-Type", "WARC-Record-ID", "WARC-Date",
    "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Block-Digest", "WARC-Profile",
    "WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date",
    "WARC-Segment-Number", "WARC-Segment-Origin-ID", "WARC-Segment-Total-Length",
)
OWN_NAMES = ("X-Page-ID", "X-Refers-To-Page-ID")
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def chunked(payload: str) -> str:
    """Chunked transfer framing; sizes are of bytes, cuts between characters."""
    parts = []
    for at in range(0, len(payload), CHUNK_CHARS):
        piece = payload[at : at + CHUNK_CHARS]
        parts.append(f"{size(piece):x}\r\n{piece}\r\n")
    return "".join(parts) + "0\r\n\r\n"


def header_value(text: str) -> str:
    """A value of one line: control characters become percent codes."""
    if text.isprintable():
        return text
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def record(headers: list[tuple[str, object]], block: str) -> str:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {size(block)}"]
    return "\r\n".join(lines) + END + block


def record_id(row: int, segment: int, name: str | None = None) -> str:
    """An identifier by the row's number, or by a name that revisits know too."""
    if name is None:
        return f"<urn:uuid:{uuid.UUID(int=row << 32 | segment)}>"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{name}:{segment}')}>"


def records(
    row, page_id, url, html, digest, length, refers_to, name=None, target=None, target_uri=None
) -> list[str]:
    """The records of one page, without the line feeds that end a record.

    ``name`` stands for the row in its identifiers; a revisit tells those of ``target``.
    """
    common = [
        ("WARC-Date", DATE),
        ("WARC-Target-URI", header_value(url or f"urn:page:{page_id}")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if page_id is not None:
        common.append(("X-Page-ID", page_id))
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        block = f"{HTTP}Content-Length: {length}{END}"
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(row, 1)), *common]
        head += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", refers_to), kind]
        if target is not None:
            uri = header_value(target_uri or f"urn:page:{refers_to}")
            head += [("WARC-Refers-To", record_id(row, 1, target))]
            head += [("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", DATE)]
        return [record(head, block)]
    block = f"{HTTP}Transfer-Encoding: chunked{END}{chunked(html)}"
    parts = [block[i : i + SEGMENT_CHARS] for i in range(0, len(block), SEGMENT_CHARS)]
    origin = record_id(row, 1, name)
    made = []
    for n, part in enumerate(parts, 1):
        head = [
            ("WARC-Type", "response" if n == 1 else "continuation"),
            ("WARC-Record-ID", record_id(row, n, name)),
            *common,
        ]
        if len(parts) > 1:
            head.append(("WARC-Segment-Number", n))
            if n > 1:
                head.append(("WARC-Segment-Origin-ID", origin))
            if n == len(parts):
                head.append(("WARC-Segment-Total-Length", size(block)))
        made.append(record([*head, kind], part))
    return made


def with_digests(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(column("html"), F.lit(""))
    return pages.select(
        column("page_id").alias("page_id"),
        column("url").alias("url"),
        payload.alias("html"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("length"),
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for every row of ``pages`` (``page_id``, ``url``, ``html``) as gzip
    files below ``path``.

    Of equal payloads of at least 100 bytes the one with the smallest ``page_id`` is a
    response and the others revisit it; where that id repeats each of its rows is a
    response, and rows without an id revisit unless no copy has one.  Null payloads are
    empty, other columns are not read, and an empty table writes no record.  Repeated
    payloads are counted before they are joined, so a large group of copies is one row.
    Revisits name the record they refer to, unless rows repeat its ``page_id``.
    """
    sized = with_digests(pages)
    first = (
        sized.where(F.col("length") >= LEAST_REVISIT_BYTES)
        .groupBy("digest", "page_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("url").alias("url"))
        .groupBy("digest")
        .agg(
            F.sum("rows").alias("copies"),
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "rows", "url"))).alias("of"),
        )
        .where("copies > 1 AND of IS NOT NULL")
        .select(
            F.col("digest").alias("_digest"),
            F.col("of.page_id").alias("first"),
            (F.col("of.rows") == 1).alias("alone"),
            F.col("of.url").alias("first_url"),
        )
    )
    first = store(first, "first-copies")
    joined = sized.join(first, F.col("digest") == F.col("_digest"), "left")
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = joined.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        "url",
        F.when(F.col("first").isNotNull() & other, F.lit("")).otherwise(F.col("html")).alias("html"),
        "digest",
        "length",
        F.when(other, F.col("first")).alias("refers_to"),
        F.when(~other & F.col("alone"), F.col("digest")).alias("name"),
        F.when(other & F.col("alone"), F.col("digest")).alias("target"),
        F.when(other, F.col("first_url")).alias("target_uri"),
    )
    fields = T.StructType([T.StructField("records", T.ArrayType(T.StringType(), False), False)])

    def start():
        return lambda *columns: [(records(*values),) for values in zip(*columns)]

    made = annotate(ready, ready.columns, [], "made", fields, start)
    made.select(F.explode("made.records").alias("value")).write.option("lineSep", END).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", FILE_RECORDS).text(path)


_CANONICAL = {name.lower(): name for name in (*NAMES, *OWN_NAMES)}
_VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n")
_HEADERS_END = re.compile(rb"\r?\n\r?\n")
_RECORD_END = re.compile(rb"(?:\r?\n){2}|[\r\n]*\Z")
_NEXT = re.compile(rb"\n(?=WARC/[0-9]+\.[0-9]+\r?\n)")


def header_fields(text: str) -> dict[str, str]:
    """Fields by name, known names as the format writes them, whatever their case.

    Lines that start with a blank go on the field before; lines without a colon are skipped;
    of a field that comes twice the first counts.
    """
    fields: dict[str, str] = {}
    name = None
    for line in re.split(r"\r?\n", text):
        if line[:1] in (" ", "\t") and name is not None:
            fields[name] = f"{fields[name]} {line.strip()}".strip()
            continue
        key, colon, value = line.partition(":")
        name = _CANONICAL.get(key.strip().lower(), key.strip()) if colon else None
        if name in fields:
            name = None
        elif name is not None:
            fields[name] = value.strip()
    return fields


def _record_at(data: bytes, at: int) -> tuple[dict[str, str], int, int] | None:
    version = _VERSION.match(data, at)
    stop = version and _HEADERS_END.search(data, version.end() - 1)
    if not stop:
        return None
    headers = header_fields(data[version.end() : stop.start()].decode(errors="replace"))
    length = headers.get("Content-Length", "")
    if not (length.isascii() and length.isdigit()):
        return None
    end = stop.end() + int(length)
    if end > len(data) or not _RECORD_END.match(data, end):
        return None  # cut short, or followed by more than the end of a record
    return headers, stop.end(), end


def parsed(data: bytes) -> Iterator[tuple[dict[str, str] | None, int, int]]:
    """Headers, start and end of the block of each record of any version.

    Of a damaged stretch the headers are None; the next line that starts a record ends it.
    """
    at = 0
    while True:
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return
        found = _record_at(data, at)
        if found is None:
            after = _NEXT.search(data, at + 1)
            found = None, at, after.end() if after else len(data)
        yield found
        at = found[2]


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    parts, at = [], 0
    try:
        while True:
            stop = body.index(b"\r\n", at)
            length = int(body[at:stop].split(b";")[0], 16)
            at = stop + 2
            if not length:
                return b"".join(parts)
            parts.append(body[at : at + length])
            if len(parts[-1]) != length or body[at + length : at + length + 2] != b"\r\n":
                return None
            at += length + 2
    except ValueError:
        return None


def payload_of(block: bytes) -> bytes | None:
    """The decoded body of an HTTP response."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def whole_number(headers: dict[str, str], name: str) -> int | None:
    """The value of a field if it is a whole number of 64 bits."""
    value = headers.get(name, "")
    if not re.fullmatch(r"-?[0-9]{1,19}", value, re.ASCII):
        return None
    number = int(value)
    return number if -(1 << 63) <= number < 1 << 63 else None


PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("uri", T.StringType()),
        T.StructField("record_type", T.StringType(), False),
        T.StructField("refers_to", T.LongType()),
        T.StructField("refers_to_record", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("declared_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
#: A page, or a segment of one: then ``payload`` is its part of the block.
RECORD = T.StructType(
    [
        *PAGE.fields,
        T.StructField("origin", T.StringType()),
        T.StructField("segment", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)


def unpacked(data: bytes) -> bytes:
    """An archive file as bytes; of a gzip file with a damaged member what comes before."""
    if data[:2] != b"\x1f\x8b":
        return data
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        parts = []
        while data[:2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            try:
                parts.append(member.decompress(data))
            except zlib.error:
                break
            data = member.unused_data if member.eof else b""
        return b"".join(parts) + b"\r\n\r\n(damaged)"


def record_row(headers: dict[str, str] | None, block: bytes) -> tuple | None:
    """A row of ``RECORD``, None for records that hold no page."""
    if headers is None:
        return (None, None, "damaged", *[None] * (len(RECORD) - 3))
    kind = headers.get("WARC-Type", "").lower()
    segment = whole_number(headers, "WARC-Segment-Number")
    if kind not in ("response", "resource", "revisit", "continuation"):
        return None
    name = headers.get("WARC-Record-ID")
    if kind == "continuation":
        name = headers.get("WARC-Segment-Origin-ID")
    declared, payload, origin = None, block, None
    if segment is not None and name is not None:
        origin = name
    elif kind == "continuation":
        return record_row(None, block)  # it cannot be told where it belongs
    else:
        segment = None
        if kind == "revisit":
            fields = header_fields(_HEADERS_END.split(block, 1)[0].decode(errors="replace"))
            declared, payload = whole_number(fields, "Content-Length"), None
        elif kind == "response":
            payload = payload_of(block)
    digest = headers.get("WARC-Payload-Digest")
    return (
        whole_number(headers, "X-Page-ID"),
        headers.get("WARC-Target-URI"),
        kind,
        whole_number(headers, "X-Refers-To-Page-ID"),
        headers.get("WARC-Refers-To"),
        digest and digest.removeprefix("sha256:"),
        declared,
        payload,
        origin,
        segment,
        whole_number(headers, "WARC-Segment-Total-Length"),
    )


def _rows(batch: pa.RecordBatch) -> list[list]:
    rows: list[list] = [[] for _ in RECORD]
    for value in batch.column(0):
        data = unpacked(value.as_py())
        for headers, begin, end in parsed(data):
            row = record_row(headers, data[begin:end])
            for out, item in zip(rows, row or ()):
                out.append(item)
    return rows


def reassembled(parts: list[dict], http: bool = True) -> bytes | None:
    """The payload of segments in order; None unless they are numbered 1, 2, ... without a
    gap, the last one tells the total length, and that is their length."""
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        return None
    block = b"".join(p["block"] for p in parts)
    if parts[-1]["total"] != len(block):
        return None
    return payload_of(block) if http else block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page in the archives below ``path``, with its payload.

    Continuation records may lie in other files than the record they go on from: segments
    are grouped by the origin's identifier, a group being one page.  A page whose segments
    or chunks are incomplete has a null payload.  Revisits have no payload but the digest
    and length that they declare.

    Archives of others are read too: any version, fields in any case, folded or unknown, no
    page number (null), payloads of ``resource`` records as they stand, digests of other
    kinds with their prefix.  Records that hold no page (``warcinfo``, ``request`` and such)
    are skipped.  A damaged stretch of an archive, or a continuation that names no origin,
    is one row of type ``damaged``, all else in it null, and reading goes on at the next
    record.  Each file is unpacked and parsed once, into a stored table.
    """
    schema = T.StructType([T.StructField("content", T.BinaryType())])
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ).select("content")
    assert files.schema.simpleString() == schema.simpleString()
    read = store(expand(files, RECORD, lambda: _rows), "warc-records")
    whole = read.where("segment IS NULL").select(*PAGE.fieldNames())
    # All but the payload is told by the first segment.
    told = [n for n in PAGE.fieldNames() if n not in ("payload", "record_type")]
    first = F.min(F.when(F.col("segment") == 1, F.struct("record_type", *told)))
    other = F.min(F.struct(F.lit("response").alias("record_type"), *told))
    grouped = (
        read.where("segment IS NOT NULL")
        .groupBy("origin")
        .agg(
            F.coalesce(first, other).alias("told"),
            F.sort_array(
                F.collect_list(F.struct("segment", "total", F.col("payload").alias("block")))
            ).alias("parts"),
        )
        .select("told.*", "parts")
    )
    fields = T.StructType([T.StructField("payload", T.BinaryType())])
    names = PAGE.fieldNames()[:-1]

    def start():
        return lambda all_, kinds: [
            (reassembled(parts, kind != "resource"),) for parts, kind in zip(all_, kinds)
        ]

    joined = annotate(grouped, ["parts", "record_type"], names, "made", fields, start)
    return whole.unionByName(joined.select(*names, "made.payload"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    read = read_archives(spark, path)
    revisit = F.col("record_type") == "revisit"
    return read.select(
        "page_id",
        F.when(revisit, F.col("declared_bytes"))
        .otherwise(F.octet_length("payload").cast("long"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest"))
        .otherwise(F.sha2("payload", 256))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE = f"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id
  FROM sized WHERE payload_bytes >= {LEAST_REVISIT_BYTES} GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM sized LEFT JOIN firsts USING (payload_digest)
"""
