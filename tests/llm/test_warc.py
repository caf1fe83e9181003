"""Operator 2: round trip, revisits and damage."""

import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import warc

COLUMNS = "page_id bigint, url string, html string, digest string, original int"


def write(spark, rows, folder, **settings):
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], COLUMNS)
    return warc.write_archives(
        pages, str(folder), page_id=F.col("page_id"), url=F.col("url"), payload=F.col("html"), frame_bytes=4000, **settings
    )


ROWS = [
    (3, "http://a/", "same"), (2, "http://b/\r\nX: y 100%", "same"), (2, "http://b/", "same"), (None, None, "same"), (7, "u", None), (8, "u", ""),
    (9, "http://c/", "long " * 20000), (10, "http://d/", "crlf\r\n\r\nin body é"), (None, "n", "alone"), (None, "n", "alone"),
] + [(100 + k, f"http://e/{k}", "copy") for k in range(60)]


def test_round_trip(spark, tmp_path):
    index = write(spark, ROWS, tmp_path / "a")
    found = warc.read_archives(index, str(tmp_path / "a")).collect()
    assert len(found) == len(ROWS)
    firsts = {"same": 2, "": 7, "copy": 100}
    for r in found:
        body = {r2[0]: r2[2] or "" for r2 in ROWS if r2[0] is not None}.get(r["page_id"])
        body = body if body is not None else {None: "same", "n": "alone"}[r["url"]]
        raw = body.encode()
        first = firsts.get(body)
        revisit = first is not None and r["page_id"] != first
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (first if revisit else None)
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r["payload"] == (None if revisit else raw)
    urls = {(r["page_id"], r["url"]) for r in found}
    assert (2, "http://b/\r\nX: y 100%") in urls and (None, None) in urls


def test_small_payloads_are_no_revisits(spark, tmp_path):
    index = write(spark, ROWS, tmp_path / "b", smallest_revisit=5)
    assert {r["record_type"] for r in warc.read_archives(index, str(tmp_path / "b")).collect()} == {"response"}


def test_seek_table_and_plain_decoding(spark, tmp_path):
    index = write(spark, ROWS, tmp_path / "c")
    for name in {r["archive"] for r in index.collect()}:
        data = (tmp_path / "c" / name).read_bytes()
        frames = warc.read_seek_table(io.BytesIO(data), len(data))
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert len(whole) == sum(f[2] for f in frames) and whole.startswith(b"WARC/1.1")
        for at, packed, size, _ in frames:
            assert len(zstandard.ZstdDecompressor().decompress(data[at: at + packed], max_output_size=size)) == size


def test_archives_roll_over(spark, tmp_path):
    index = write(spark, ROWS, tmp_path / "r", archive_bytes=300)
    assert index.select("archive").distinct().count() > 3
    assert warc.read_archives(index, str(tmp_path / "r")).count() == len(ROWS)


def test_damage_is_found(spark, tmp_path):
    name, record = warc.make_record(1, "u", b"body", warc.base32_sha1(b"body"), None, "2024-01-01T00:00:00Z", "")
    assert warc.parse_record(record)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"body", b"bodx"))
    with pytest.raises(ValueError):
        warc.parse_record(record[:-1])


def test_empty_table(spark, tmp_path):
    index = write(spark, ROWS, tmp_path / "e").limit(0)
    assert warc.read_archives(index, str(tmp_path / "e")).count() == 0
    assert write(spark, [], tmp_path / "f").count() == 0
