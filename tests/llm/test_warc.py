"""Archives written and read back, damaged segments, and framing."""

import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from ordertrail.llm import warc
from ordertrail.llm.queries import op1_warc
from ordertrail.session import scratch_path


def expected(pages):
    last = {}
    for key, payload in pages:
        if len(payload) >= 1000:
            last[payload] = max(last.get(payload, key), key)
    out = []
    for key, payload in pages:
        to = last.get(payload, key)
        out.append((key, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if to != key else "response",
                    to if to != key else None))
    return sorted(out)


def test_query(spark, folder):
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    rows = op1_warc(spark, folder).collect()
    assert all(r["valid"] for r in rows)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(tuple(r[n] for n in names) for r in rows) == expected(pages)


def round_trip(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "page_id long, url string, payload binary, size string")
    path = scratch_path(spark, "archives")
    warc.write_archives(df, path, "page_id", "url", "payload", **sizes)
    records = warc.read_records(spark, path)
    return path, records, warc.payloads(warc.reassemble(records))


def test_rows(spark):
    big, mixed = bytes(range(256)) * 40, b"WARC/1.1\r\n\r\n\r\nContent-Length: 5\r\n\r\n" * 100
    rows = [(1, "http://a", big, "x"), (2, "http://b", big, "x"), (3, None, big, "x"), (3, None, big, "x"),
            (None, "http://c\r\nX: y", big, "x"), (4, "u", None, "x"), (5, "u", b"", None), (6, "u", mixed, "x"),
            (7, "u", b"s" * 999, "x"), (8, "u", b"s" * 999, "x"), (9, "é", b"\xff\xfe" * 30000, "x"), (None, "u", mixed[:-1], "x")]
    path, records, found = round_trip(spark, rows, segment_bytes=500, chunk_bytes=77, records_per_file=40)
    got = found.collect()
    assert len(got) == len(rows) and all(r["valid"] for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r["source_id"], []).append(r)
    assert [r["record_type"] for r in by_id["3"]] == ["response"] * 2
    for key in ("1", "2"):
        (r,) = by_id[key]
        assert (r["record_type"], r["refers_to"], r["payload"], r["payload_bytes"]) == ("revisit", "3", None, len(big))
    assert sorted((r["record_type"], r["refers_to"]) for r in by_id[None]) == [("response", None), ("revisit", "3")]
    for key, _, payload, _ in rows:
        if key in (4, 5, 6, 7, 8, 9):
            (r,) = by_id[str(key)]
            assert (r["record_type"], r["payload"]) == ("response", payload or b"")
    assert records.where("record_type = 'continuation'").count() > 100
    files = glob.glob(f"{path}/part-*")
    assert len(files) > 3
    for file in files:  # whole records only, none beyond its bound
        with open(file, "rb") as opened:
            blocks = [block for _, block in warc.parse_records(opened.read())]
        assert len(blocks) <= 40 and all(len(b) <= 500 for b in blocks)


def test_no_rows(spark):
    assert round_trip(spark, [])[2].count() == 0


def test_damaged_segments(spark):
    payload = bytes(range(250)) * 20
    rows = [(i, "u", payload + bytes([i]), None) for i in range(5)]
    _, records, _ = round_trip(spark, rows, segment_bytes=1000, chunk_bytes=100)
    ids = {r["source_id"]: r["record_id"] for r in records.where("source_id is not null").collect()}
    origin = F.coalesce("origin_id", "record_id")
    lost = records.where(~((origin == ids["0"]) & (F.col("segment") == 3)) & ~((origin == ids["1"]) & F.col("origin_id").isNull())
                         & ~((origin == ids["2"]) & F.col("total_length").isNotNull()))
    other = records.where((origin == ids["3"]) & (F.col("segment") == 2)).withColumn("block", F.lit(b"other"))
    damaged = lost.unionByName(other).unionByName(records.where(origin == ids["4"]))  # the last only repeated
    got = {r["record_id"]: r for r in warc.payloads(warc.reassemble(damaged)).collect()}
    assert len(got) == 5
    for key in "0123":
        assert not got[ids[key]]["valid"] and got[ids[key]]["payload"] is None
    assert got[ids["4"]]["valid"] and got[ids["4"]]["payload"] == payload + bytes([4])


def test_framing():
    assert warc.unchunk(b"3\r\nabc\r\nA;x=y\r\n0123456789\r\n0\r\nT: 1\r\n\r\n") == b"abc0123456789"
    for broken in (b"", b"3\r\nab", b"3\r\nabcd\r\n0\r\n\r\n", b"z\r\n", b"0\r\n", b"-1\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunk(broken)
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))
