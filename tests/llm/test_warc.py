import base64
import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tether.llm import warc
from tether.session import fresh_path

START = "\r\n\r\nWARC/1.1\r\n"


def read_back(spark, pages, **options):
    path = fresh_path(spark, "archive")
    warc.write_archive(pages, path, **options)
    return warc.payloads(warc.reassembled(warc.read_records(spark, path)))


def brute(rows, least=0):
    """``rows``: (page id, html)."""
    bodies = [(k, (h or "").encode()) for k, h in rows]
    first = {}
    for key, body in bodies:
        if key is not None:
            first[body] = min(key, first.get(body, key))
    out = Counter()
    for key, body in bodies:
        again = len(body) >= least and body in first and key != first[body]
        out[key, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first[body] if again else None] += 1
    return out


ODD = [
    (1, f"a{START}WARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz" * 300), (2, None), (3, "é€" * 9000), (4, ""), (None, "body"), (5, "body"), (6, "body"),
    (7, "\r\n\r\n\r\n"), (8, START * 3), (9, "0\r\n\r\n"), (10, "x" * 300_000), (3, "é€" * 9000), (11, "only null shares"), (12, "Content-Length: 9"),
]


@pytest.mark.parametrize("segment", [97, 1001, 8192])
def test_round_trip_of_odd_pages(spark, segment):
    pages = spark.createDataFrame([(k, "http://x/\r\nA: b", h, "k", 1) for k, h in ODD if segment > 500 or len(h or "") < 20_000], "page_id long, url string, html string, type string, block int")
    got = read_back(spark, pages, segment_bytes=segment)
    assert got.where("reason is not null").collect() == []
    assert Counter(map(tuple, warc.page_records(got).collect())) == brute([(r.page_id, r.html) for r in pages.collect()])
    bodies = Counter(bytes(r.payload) for r in got.where("type = 'response'").collect())
    assert set(bodies) == {(r.html or "").encode() for r in pages.collect()}


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    twice = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000))
    for table in (pages, twice):
        assert Counter(map(tuple, warc.page_records(read_back(spark, table)).collect())) == brute([(r.page_id, r.html) for r in table.collect()])


def test_least_size_of_a_revisit(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert Counter(map(tuple, warc.page_records(read_back(spark, pages, min_bytes=3)).collect())) == brute([(1, "ab"), (2, "ab"), (3, "abc"), (4, "abc")], 3)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = fresh_path(spark, "archive")
    warc.write_archive(pages, path)
    assert warc.page_records(warc.payloads(warc.reassembled(warc.read_records(spark, path)))).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "\r\n", START, "WARC/1.1", "\r", "\n", "é", "Content-Length: 4"]), max_size=12).map("".join), st.integers(60, 200))
def test_records_survive_any_cut(body, segment):
    records = warc.records_of("1", 0, "u", body.encode(), None, segment) + warc.records_of("2", 1, "u", b"next", None, segment)
    file = b"".join(r + b"\r\n\r\n" for r in records)
    read = list(warc.records_in(("f", piece) for piece in file.split(START.encode())))
    blocks = [r.partition(b"\r\n\r\n")[2] for r in records]
    assert [r["block"] for r in read] == blocks and all(r["reason"] is None for r in read)


@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_framing(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


def test_chunk_extensions_and_broken_chunks():
    assert warc.dechunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_faulty_records_get_a_reason(spark):
    part = {"record_id": "o", "type": "response", "refers_to": None, "digest": None, "origin": None, "number": 1, "total": None, "block": b"ab", "reason": None}
    rest = {**part, "type": "continuation", "origin": "o"}

    def reason(*records):
        rows = [tuple({**r, "block": bytearray(r["block"])}.values()) for r in records]
        return [r.reason for r in warc.reassembled(spark.createDataFrame(rows, warc.RECORD_TYPES)).collect()]

    assert reason(part, {**rest, "record_id": "p", "number": 2, "total": 4}) == [None]
    assert reason({**rest, "record_id": "p", "number": 2, "total": 4}) == ["segments missing"]
    assert reason(part, {**rest, "record_id": "p", "number": 2, "total": 5}) == ["wrong total length"]
    assert reason(part, {**rest, "record_id": "p", "number": 2}) == ["no total length"]
    assert reason(part, part, {**rest, "record_id": "p", "number": 2, "total": 6}) == ["segments missing"]
    assert [r["reason"] for r in warc.records_in(iter([("f", b"Content-Length: 9\r\n\r\nabc"), ("g", b"no length")]))] == ["cut short", "no length"]
