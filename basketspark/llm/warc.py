"""WARC archives: writing with deduplication and segments, reading with segment reassembly.

A payload is sent as an HTTP response with chunked transfer framing. A response longer than ``segment_bytes``
is spread over continuation records, which may lie in other archives; reading groups them by the identifier of
their origin, orders them by segment number, verifies the total length and takes the framing off again.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.common import Written, input_file, map_frames, output_file

CRLF = b"\r\n"
# Names from the archive format's standard.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int = 8192) -> bytes:
    """Chunked transfer framing: hexadecimal length, bytes, and an empty chunk at the end."""
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The bytes inside chunked framing; chunk extensions and trailers are skipped. Raises if it is cut short."""
    out, at = [], 0
    while True:
        end = data.index(CRLF, at)
        n = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if len(data) < at + n + 2 or data[at + n : at + n + 2] != CRLF:
            raise ValueError("chunk cut short")
        out.append(data[at : at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response block."""
    head, body = block.split(CRLF + CRLF, 1)
    framed = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(CRLF)[1:])
    return unchunked(body) if framed else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record, compressed by itself so that archives can be read from any record on."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + block + CRLF + CRLF) + z.flush()


def one_line(value: object) -> str | None:
    """A field value: line breaks and spaces are percent-encoded."""
    return None if value is None else "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in str(value))


def page_records(page_id: int | None, url: str | None, payload: bytes, origin: tuple | None, segment_bytes: int) -> Iterator[bytes]:
    """The records of a page: a revisit if ``origin`` (id known, id, url) is given, else a response in segments."""
    name = lambda: f"<urn:uuid:{uuid.uuid4()}>"
    own, digest = name(), base32_sha1(payload)
    common = [("WARC-Date", datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")), ("WARC-Target-URI", one_line(url)), ("Page-Id", page_id)]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if origin is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Payload-Digest", f"sha1:{digest}"),
                  ("WARC-Refers-To-Target-URI", one_line(origin[1])), ("Refers-To-Page-Id", origin[0]), ("Payload-Length", len(payload)),
                  ("Content-Type", "application/http; msgtype=response")]
        yield record(fields, head)
        return
    block = head + chunked(payload)
    segments = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    many = len(segments) > 1
    for number, part in enumerate(segments, 1):
        first = number == 1
        fields = [("WARC-Type", "response" if first else "continuation"), ("WARC-Record-ID", own if first else name()), *(common if first else common[:2])]
        if first:
            fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
        if many:
            fields += [("WARC-Segment-Number", number), ("WARC-Segment-Origin-ID", None if first else own), ("WARC-Block-Digest", f"sha1:{base32_sha1(part)}")]
            fields += [("WARC-Segment-Total-Length", len(block) if number == len(segments) else None)]
        yield record(fields, part)


def write_archives(pages: DataFrame, folder: str, least_revisit: int = 0, segment_bytes: int = 16_384) -> DataFrame:
    """Write a record a page (page_id, url, html) under ``folder``; returns the files: file, records.

    Of pages with equal payloads of at least ``least_revisit`` bytes, that with the smallest page_id (null last)
    is a response, and others are revisits of it; should that page_id be repeated, the row of the smallest url is
    the response, and rows alike in all of this are all responses. Null html is an empty payload. A task writes
    files of its own name and lists them when they are complete; files of failed attempts are never read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    rank = F.struct(F.col("page_id").isNull().alias("unknown"), F.col("page_id").alias("id"), F.col("url").alias("url"))
    firsts = (
        rows.filter(F.length("payload") >= least_revisit).groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    same = F.col("first").isNull() | (F.col("page_id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url")))
    marked = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", F.when(~same, F.col("first.id")).alias("origin_id"), F.when(~same, F.col("first.url")).alias("origin_url"), (~same).alias("revisit")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        with output_file(name) as out:
            out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            for batch in batches:
                for page_id, url, payload, origin_id, origin_url, revisit in batch.itertuples(index=False, name=None):
                    origin = (whole(origin_id), origin_url) if revisit else None
                    for part in page_records(whole(page_id), url, payload, origin, segment_bytes):
                        out.write(part)
                    n += 1
        if n:
            yield pd.DataFrame([(name, n)], columns=["file", "records"])

    return Written(spark, "warc-files").keep(map_frames(marked, write, "file string, records long"), "files")


def whole(value) -> int | None:
    return None if value is None or pd.isna(value) else int(value)


RECORD = "kind string, record_id string, origin string, segment long, total_length long, page_id long, refers_to long, url string, digest string, payload_length long, block binary"


def read_records(files: DataFrame, read_bytes: int = 1 << 20) -> DataFrame:
    """One row a record of the listed archives. A file is streamed; at most one record is held at a time."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch.file:
                rows, size = [], 0
                with input_file(file) as source:
                    for data in members(source, read_bytes):
                        rows.append(parsed(data))
                        size += len(data)
                        if size > 8 * read_bytes:
                            yield record_frame(rows)
                            rows, size = [], 0
                if rows:
                    yield record_frame(rows)

    n = max(1, files.count())
    return files.select("file").repartition(n, "file").mapInPandas(read, RECORD)


def members(source, read_bytes: int) -> Iterator[bytes]:
    """The decompressed members of a compressed archive, one record each."""
    z, parts = zlib.decompressobj(31), []
    while data := source.read(read_bytes):
        while data:
            parts.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(parts)
                z, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("archive cut short")


def parsed(data: bytes) -> tuple:
    head, rest = data.split(CRLF + CRLF, 1)
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/") or len(rest) != n + 4:
        raise ValueError("not a complete record")
    number = lambda k: int(fields[k]) if k in fields else None
    return (fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Segment-Origin-ID"), number("WARC-Segment-Number"), number("WARC-Segment-Total-Length"),
            number("Page-Id"), number("Refers-To-Page-Id"), fields.get("WARC-Target-URI"), fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
            number("Payload-Length"), rest[:n])


def record_frame(rows: list[tuple]) -> pd.DataFrame:
    columns = [c.split()[0] for c in RECORD.split(", ")]
    out = pd.DataFrame(rows, dtype=object, columns=columns)
    return out.astype({c: "Int64" for c in ("segment", "total_length", "page_id", "refers_to", "payload_length")})


def reassembled(records: DataFrame) -> DataFrame:
    """Records of type response and revisit with whole blocks.

    Only records of several segments are shuffled: grouped by origin identifier, ordered by segment number, and
    checked for gaps and against the total length that the last one states; ``complete`` tells the outcome.
    """
    kept = records.filter("kind IN ('response', 'revisit', 'continuation')")
    columns = ["kind", "record_id", "page_id", "refers_to", "url", "digest", "payload_length"]
    single = kept.filter("segment IS NULL").select(*columns, "block", F.lit(True).alias("complete"))
    part = F.struct("segment", "block", "total_length")
    head = F.struct(*columns)
    grouped = (
        kept.filter("segment IS NOT NULL")
        .groupBy(F.coalesce("origin", "record_id").alias("origin"))
        .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max(F.when(F.col("segment") == 1, head)).alias("head"))
    )
    block = F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.block))")
    ordered = F.expr("transform(parts, p -> p.segment) = transform(sequence(1, size(parts)), i -> CAST(i AS BIGINT))")
    many = grouped.select("head.*", block.alias("block"), F.element_at("parts", -1)["total_length"].alias("stated"), ordered.alias("in_order"))
    complete = F.coalesce(F.col("in_order") & (F.length("block") == F.col("stated")), F.lit(False))
    return single.unionByName(many.select(*columns, "block", complete.alias("complete")))


def payloads(whole_records: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload, digest and bytes of the payload, as read and decoded.

    A response's digest is computed from the decoded payload and must equal the stated one. A revisit has no
    payload of its own and states digest and length of the one it refers to. Incomplete records raise.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.complete.all():
                raise ValueError("a segmented record is not complete")
            body = [None if kind == "revisit" else http_payload(bytes(block)) for kind, block in zip(batch.kind, batch.block)]
            digest = [stated if b is None else base32_sha1(b) for b, stated in zip(body, batch.digest)]
            if any(a != b for a, b in zip(digest, batch.digest)):
                raise ValueError("a payload does not have the stated digest")
            size = [n if b is None else len(b) for b, n in zip(body, batch.payload_length)]
            yield pd.DataFrame({"page_id": batch.page_id.astype("Int64"), "url": batch.url, "record_type": batch.kind, "refers_to": batch.refers_to.astype("Int64"),
                                "payload": body, "payload_digest": digest, "payload_bytes": pd.array(size, "Int64")})

    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_digest string, payload_bytes long"
    return map_frames(whole_records, decode, schema)


def archive_round_trip(pages: DataFrame, folder: str, least_revisit: int = 0, segment_bytes: int = 16_384) -> DataFrame:
    """Write the archives, read them back, reassemble and decode."""
    return payloads(reassembled(read_records(write_archives(pages, folder, least_revisit, segment_bytes))))
