from __future__ import annotations

import base64
import hashlib

import pytest

from plumbline.llm import common, queries, warc

PAGES = "page_id long, url string, html string, path string"


def _fake(length: int) -> str:
    return f"WARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: 99\r\nContent-Length: {length}\r\n\r\n" + "x" * length + "\r\n\r\n"


def _pages(spark):
    rows = [(5, "u5", "same", "p"), (2, "u2", "same", "p"), (9, "u9", "same", "p"), (3, None, None, "p"), (4, "a\r\nb: c", "", "p"), (6, "u6", "pre" + _fake(4) + _fake(10**6), "p"), (7, "u7", _fake(3) * 50, "p"), (8, "u8", "WARC/1.0\r\n" * 20, "p"), (None, "n", "alone", "p"), (10, "é", "é" * 5000, "p"), (11, "t", "\r\n\r\nWARC/1.0\r\n", "p"), (2, "u2", "same", "p")]
    return spark.createDataFrame(rows, PAGES), rows


def _check(found, rows, least=0):
    assert len(found) == len(rows)
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for r in found:
        html = next(h or "" for i, _, h, _ in rows if i == r["page_id"])
        raw = html.encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        again = r["page_id"] is not None and len(raw) >= least and first[html] != r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[html]) if again else ("response", None))


def test_false_heads_in_payloads(spark):
    pages, rows = _pages(spark)
    files = warc.write_warc(pages.coalesce(2), common.scratch(spark, "w"))
    for size in (64, 700, 8 << 20):
        _check(warc.read_warc(files, range_bytes=size).collect(), rows)


def test_heads_of_any_length(spark):
    rows = [(1, "u1", "one", "p"), (2, "data:" + "x" * 300_000, "two", "p"), (3, "u3", "three", "p"), (4, "y" * 70_000, "", "p"), (5, "u5", "five", "p")]
    files = warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), common.scratch(spark, "w"))
    for size in (20_000, 8 << 20):
        found = warc.read_warc(files, range_bytes=size).collect()
        _check(found, rows)
        assert {(r["page_id"], r["url"]) for r in found} == {(r[0], r[1]) for r in rows}


def test_a_lost_record_is_an_error(spark):
    rows = [(i, f"u{i}", f"text {i}", "p") for i in range(5)]
    files = warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), common.scratch(spark, "w"))
    path = files.first()["path"].removeprefix("file://")
    with open(path, "rb") as f:
        data = f.read()
    at = data.find(warc.MAGIC, 1)
    with open(path, "wb") as f:
        f.write(data[:at] + b"X" + data[at + 1 :])
    with pytest.raises(ValueError, match="5 records were written, but 1 are found"):
        warc.read_warc(files)


def test_a_chain_that_stops_is_an_error(spark):
    rows = [(i, f"u{i}", f"text {i}", "p") for i in range(3)]
    files = warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), common.scratch(spark, "w"))
    path = files.first()["path"].removeprefix("file://")
    with open(path, "ab") as f:
        f.write(b"junk")
    with pytest.raises(ValueError, match="end at"):
        warc.read_warc(files.select("path", (files["bytes"] + 4).alias("bytes")))


def test_a_head_of_many_megabytes(spark):
    rows = [(1, "u1", "one", "p"), (2, "data:" + "x" * 10_000_000, "two", "p"), (3, "u3", "three", "p")]
    files = warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), common.scratch(spark, "w"))
    found = warc.read_warc(files).collect()
    _check(found, rows)
    assert {len(r["url"]) for r in found} == {2, 10_000_005}


def test_small_payloads_are_responses(spark):
    pages, rows = _pages(spark)
    _check(warc.archive(pages, least_bytes=5).collect(), rows, least=5)


def test_rolls_files(spark):
    pages, rows = _pages(spark)
    files = warc.write_warc(pages, common.scratch(spark, "w"), file_bytes=1)
    assert files.count() > 1
    _check(warc.read_warc(files).collect(), rows)


def test_empty(spark):
    assert warc.archive(_pages(spark)[0].limit(0)).count() == 0


def test_query(spark, sf, duck, same):
    assert same(queries.op4_warc(spark, sf), duck, queries.ORACLE["op4_warc"]) > 1
