"""WARC archives: exact round trips, revisits, segments, streaming."""

import base64
import gzip
import hashlib
import io
import random

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from censuskit.llm import warc
from censuskit.llm.shared import scratch_path
from tests.conftest import SF001


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows, least=0):
    out = []
    for k, _, p in rows:
        data = (p or "").encode()
        same = [i for i, _, q in rows if i is not None and (q or "").encode() == data]
        first = min(same, default=None) if len(data) >= least else None
        revisit = first is not None and first != k
        out.append((str(k), len(data), digest(data), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, None), (9, "u", ""), (4, "u", "é" * 1000), (5, "u", "x\r\n\r\nWARC/1.1\r\n\r\n" * 3),
    (6, "u", "long " * 500_000), (7, "u", "same"), (7, "u", "same"), (1, "http://b/", "same"), (1, "u", "other"), (None, "u", "same"), (None, "u", "lone"),
]


@pytest.mark.parametrize("least,segment,chunk,size", [(0, warc.SEGMENT, warc.CHUNK, warc.FILE_BYTES), (5, 100_000, 30_000, 1_000)])
def test_round_trip(spark, least, segment, chunk, size):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, refers_to string").repartition(3)
    got = warc.archive(df, least=least, segment=segment, chunk=chunk, file_bytes=size).collect()
    assert sorted(((str(r.page_id), *r[1:]) for r in got), key=str) == brute(ROWS, least)


def test_real_pages(spark):
    df = spark.read.parquet(f"{SF001}/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    got = warc.archive(df).collect()
    assert sorted(((str(r.page_id), *r[1:]) for r in got), key=str) == brute(rows)
    assert warc.archive(df.limit(0)).count() == 0


def test_chunk_table_rebuilds_payloads(spark):
    df = spark.createDataFrame([(k, u or "", p or "", None) for k, u, p in ROWS[:7]], "k long, t string, p string, r long")
    manifest = warc.write(df, scratch_path(spark, "warc-test"), "k", "t", "p", "r", segment=70_000)
    rows = sorted(warc.read(manifest, chunk=20_000).collect(), key=lambda r: (r.record_id, r.chunk_no))
    for k, _, p in ROWS[:7]:
        own = [r for r in rows if r.record_id == warc.record_id(k)]
        assert b"".join(bytes(r.data) for r in own) == (p or "").encode()
        assert [r.chunk_no for r in own] == list(range(len(own))) and [r.last for r in own] == [False] * (len(own) - 1) + [True]
        assert max(len(r.data) for r in own) <= 20_000
        sha = hashlib.sha1()
        for r in own:
            sha.update(bytes(r.data))
            assert r.running_sha1 == base64.b32encode(sha.digest()).decode()
    # Each record is a gzip member of its own, and the whole a valid archive.
    path = manifest.first().path
    fs, name = warc._open(path)
    with fs.open_input_stream(name, compression=None) as f:
        plain = gzip.decompress(f.read())
    assert plain.startswith(b"WARC/1.1\r\n") and b"WARC-Segment-Total-Length: 2500000" in plain or manifest.count() > 1


def test_reading_holds_little():
    """A payload that compresses well is read in chunks, not at once."""
    data = memoryview(b"z" * 30_000_000)
    raw = b"".join(warc.record(1, "u", None, hashlib.sha1(data).digest(), data, 1 << 30))
    plain = warc.Inflated(io.BytesIO(raw), 10_000)
    sizes = [(len(r[3]), r[9]) for r in warc.read_stream(io.BytesIO(raw), 10_000)]
    assert max(s for s, _ in sizes) == 10_000 and sizes[-1][1] == 30_000_000
    while plain.more():
        assert len(plain.held) <= 10_000
        plain.held = b""


def test_broken_archives_are_errors():
    data = memoryview(random.Random(1).randbytes(50_000))
    raw = b"".join(warc.record(1, "u", None, hashlib.sha1(data).digest(), data, 1 << 30))
    with pytest.raises(ValueError):
        list(warc.read_stream(io.BytesIO(raw[:30_000]), 10_000))
    assert isinstance(warc._open("file:/tmp/x")[0], pafs.LocalFileSystem)


HOSTILE = ["http://a/\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\n", "\x00nul", "line\nfeed", " padded ", "é%0A\t", "%0D%0A plain escapes", "http://ü/漢?q=%20\u2028", "", "\x85"]


def test_control_characters_in_targets_and_keys(spark):
    rows = [(f"k{t}", t, f"own {i}" if i % 2 else "same") for i, t in enumerate(HOSTILE)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    assert {r.page_id: r.refers_to for r in warc.archive(df).collect()} == {k: min(x for x, _, q in rows if q == p) if p == "same" and k != min(x for x, _, q in rows if q == p) else None for k, _, p in rows}
    manifest = warc.write(df.withColumn("r", F.lit(None).cast("string")), scratch_path(spark, "warc-test"), "page_id", "url", "html", "r")
    assert {(r.record_id, r.target) for r in warc.read(manifest).collect()} == {(warc.record_id(k), t) for k, t, _ in rows}


def test_a_broken_archive_is_named(spark):
    df = spark.createDataFrame([("a", "u", "text", None)], "k string, t string, p string, r string")
    path = warc.write(df, scratch_path(spark, "warc-test"), "k", "t", "p", "r").first().path
    fs, place = warc._open(path)
    with fs.open_output_stream(place, compression=None) as out:
        out.write(warc.member(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", memoryview(b"")))
    with pytest.raises(Exception, match="after its start.*Content-Length|after its start.*WARC-Record-ID"):
        warc.read(spark.createDataFrame([(path,)], "path string")).collect()
