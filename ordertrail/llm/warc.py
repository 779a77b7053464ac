"""Web archives (WARC 1.1): writing with deduplication and segments, reading with reassembly.

A record is an HTTP response in chunked framing. A payload that was seen before is a ``revisit`` without a body; a
block beyond ``segment_bytes`` goes on in ``continuation`` records. Archives are plain text tables of Spark whose
line separator is the end of a record, so they are written to any storage that Spark can write.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .arrow import Sender, arrow_schema, map_batches

CRLF = "\r\n"
#: Fixed values of the format.
VERSION, RECORD_END = "WARC/1.1", CRLF * 2
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Smaller payloads are always stored.
REVISIT_FROM = 1000
#: A file holds at most so many records of at most ``segment_bytes`` and their headers: 70 MB with these values.
RECORDS_PER_FILE, SEGMENT_BYTES, CHUNK_BYTES = 4096, 16384, 4096

RECORD = ("record_id string, record_type string, source_id string, refers_to string, payload_digest string, "
          "origin_id string, segment int, total_length bigint, block binary")


def _line(name: str, value: Column | str) -> Column:
    """A header line; none if the value is null. Line breaks in a value become spaces."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "),
                               F.lit(CRLF)), F.lit(""))


def _cut(data: Column, size: int) -> Column:
    """Pieces of at most ``size`` bytes, none of them empty."""
    count = F.ceil(F.octet_length(data) / size).cast("int")
    return F.when(count == 0, F.array().cast("array<binary>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda i: F.substring(data, i * size + 1, F.lit(size))))


def _text(data: Column) -> Column:
    """Bytes as a string that keeps them as they are."""
    return data.cast("string")


def chunked(data: Column, size: int) -> Column:
    """Chunked transfer framing of bytes, as a string."""
    chunks = F.transform(_cut(data, size), lambda c: F.concat(
        F.hex(F.octet_length(c)), F.lit(CRLF), _text(c), F.lit(CRLF)))
    return F.concat(F.array_join(chunks, ""), F.lit(f"0{RECORD_END}"))


def write_archives(df: DataFrame, path: str, key: str, url: str, payload: str, segment_bytes: int = SEGMENT_BYTES,
                   chunk_bytes: int = CHUNK_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one WARC record, and its continuations, per row of ``df``; ``payload`` is binary, null counts as empty.

    Of rows with equal payloads of at least ``REVISIT_FROM`` bytes, those with the largest key are ``response``
    records (more than one if that row is repeated; all of them if every key is null) and the others ``revisit``
    records that refer to it. An empty table writes an archive without records. Keys and URLs may be null; other
    columns are ignored. The digests of repeated payloads are written to the shared folder first, so that their
    size decides how they are joined; a payload that a third of the rows share is split by adaptive execution.
    """
    data = F.coalesce(F.col(payload), F.lit(b""))
    rows = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), data.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("bigint"), "digest": F.sha1("payload")})
    seen = stored(rows.where(F.col("size") >= REVISIT_FROM).groupBy("digest").agg(
        F.max(F.struct("key", "url")).alias("last"), F.count("*").alias("n")).where("n > 1").select(
        "digest", F.col("last.key").alias("last_key"), F.col("last.url").alias("last_url")), "repeated")
    joined = rows.join(seen, "digest", "left")
    again = F.coalesce((F.col("size") >= REVISIT_FROM) & ~F.col("key").eqNullSafe(F.col("last_key"))
                       & F.col("last_key").isNotNull(), F.lit(False))
    status = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}")
    body = F.when(F.col("again"), F.concat(status, _line("Content-Length", F.col("size")), F.lit(CRLF))).otherwise(
        F.concat(status, F.lit(f"Transfer-Encoding: chunked{RECORD_END}"), chunked(F.col("payload"), chunk_bytes)))
    records = joined.withColumn("again", again).select(
        "key", "url", "digest", "again", F.when(F.col("again"), F.col("last_key")).alias("last_key"),
        F.when(F.col("again"), F.col("last_url")).alias("last_url"),
        F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")).alias("id"), body.cast("binary").alias("block"))
    parts = records.select(
        "key", "url", "digest", "again", "last_key", "last_url", "id", F.octet_length("block").alias("total"),
        F.posexplode(_cut(F.col("block"), segment_bytes)).alias("at", "part"))
    first, many, last = F.col("at") == 0, F.col("total") > segment_bytes, \
        (F.col("at") + 1) * segment_bytes >= F.col("total")
    head = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(~first, "continuation").when(F.col("again"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.when(first, F.col("id")).otherwise(
            F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
        _line("WARC-Date", "2000-01-01T00:00:00Z"), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Segment-Number", F.when(many, F.col("at") + 1)),
        _line("WARC-Segment-Origin-ID", F.when(~first, F.col("id"))),
        _line("WARC-Segment-Total-Length", F.when(many & last, F.col("total"))),
        F.when(first, F.concat(
            _line("X-Source-ID", F.col("key")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(F.col("again"), F.concat(
                _line("WARC-Profile", IDENTICAL), _line("WARC-Refers-To-Target-URI", F.col("last_url")),
                _line("X-Refers-To-Source-ID", F.col("last_key")))).otherwise(F.lit("")))).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length("part")), F.lit(CRLF))
    (parts.select(F.concat(head, _text(F.col("part"))).alias("value"))
     .write.option("lineSep", RECORD_END).option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of one uncompressed archive."""
    at, size = 0, len(data)
    while at < size:
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split(CRLF)[1:]
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start = end + 4
        at = start + int(headers["content-length"])
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} has another length than it states")
        yield headers, data[start:at]
        at += 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``: record_id, record_type, source_id, refers_to, payload_digest, origin_id, segment,
    total_length, block. A file is read whole by one task, so archives should not exceed what a task can hold."""
    schema = arrow_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            for archive in batch.column(0):
                for headers, block in parse_records(archive.as_py() or b""):
                    number, total = headers.get("warc-segment-number"), headers.get("warc-segment-total-length")
                    if out.add(headers["warc-record-id"], headers["warc-type"], headers.get("x-source-id"),
                               headers.get("x-refers-to-source-id"),
                               headers.get("warc-payload-digest", "").partition(":")[2] or None,
                               headers.get("warc-segment-origin-id"), int(number) if number else None,
                               int(total) if total else None, block, size=len(block) + 256):
                        yield out.batch()
        yield out.batch()

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return map_batches(files.where("length > 0").select("content"), RECORD, run)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: ``records`` without origin_id, segment and total_length, with ``complete``.

    Segments are grouped by the identifier of their first record, put in order of number, and must be numbered
    from 1 without gaps and add up to the length that the last one states; else ``complete`` is false and the
    block is null. Equal copies of a segment count once; different ones of the same number are an error of the
    archive, so the record is not complete. Continuations without a first record give a row without a type.
    Unsegmented records do not take part in the shuffle.
    """
    names = ["record_id", "record_type", "source_id", "refers_to", "payload_digest"]
    single = records.where("segment is null and origin_id is null").select(*names, F.lit(True).alias("complete"), "block")
    parts = records.where("segment is not null or origin_id is not null").withColumn(
        "origin", F.coalesce("origin_id", "record_id"))
    head = F.max(F.when(F.col("origin_id").isNull(), F.struct(*names[1:]))).alias("head")
    grouped = parts.groupBy("origin").agg(
        head, F.max("total_length").alias("total"),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"))
    size = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.octet_length(p["block"]))
    in_order = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    whole = grouped.withColumn("complete", F.coalesce(
        F.col("head").isNotNull() & in_order & (size == F.col("total")), F.lit(False)))
    block = F.array_join(F.transform("parts", lambda p: _text(p["block"])), "").cast("binary")
    return single.unionByName(whole.select(
        F.col("origin").alias("record_id"), *(F.col(f"head.{n}").alias(n) for n in names[1:]), "complete",
        F.when(F.col("complete"), block).alias("block")))


def unchunk(body: bytes) -> bytes:
    """The bytes inside chunked transfer framing; raises ValueError if it is broken. Trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size < 0 or size > len(body) - at:
            raise ValueError("a chunk is cut short")
        if size == 0:
            if body.find(b"\r\n", at) < 0:
                raise ValueError("the end is missing")
            return b"".join(out)
        out.append(body[at:at + size])
        at += size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk has another size than it states")
        at += 2


def http_payload(block: bytes) -> tuple[bytes | None, int]:
    """Payload of an HTTP response, and its size; a response without a body has the size that it states."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        body = unchunk(body)
    elif not body and int(fields.get(b"content-length", b"0")):
        return None, int(fields[b"content-length"])
    return body, len(body)


def payloads(records: DataFrame) -> DataFrame:
    """``record_id``, ``record_type``, ``source_id``, ``refers_to``, ``payload_digest``, ``payload_bytes``, ``payload``
    and ``valid`` of whole records.

    ``valid`` is false if the record is not complete, its framing is broken, or its payload does not have the stated
    digest; then the payload is null. A revisit has no payload, and the digest and size of the one it refers to.
    """
    ddl = ("record_id string, record_type string, source_id string, refers_to string, payload_digest string, "
           "payload_bytes bigint, payload binary, valid boolean")
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            for name, kind, source, refers, digest, complete, block in zip(*(c.to_pylist() for c in batch.columns)):
                payload, size, valid = None, None, False
                if complete and block is not None:
                    try:
                        payload, size = http_payload(block)
                        found = digest if payload is None else hashlib.sha1(payload).hexdigest()
                        valid = digest is None or found == digest
                        digest = found
                    except ValueError:
                        payload, size = None, None
                if out.add(name, kind, source, refers, digest, size, payload if valid else None, valid,
                           size=len(payload or b"") + 256):
                    yield out.batch()
        yield out.batch()

    return map_batches(records.select("record_id", "record_type", "source_id", "refers_to", "payload_digest",
                                      "complete", "block"), ddl, run)
