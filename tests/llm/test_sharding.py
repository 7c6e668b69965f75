"""Bounded-load ring against a sequential version, row by row."""

import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from censuskit.llm import sharding
from tests.conftest import SF001


def brute(keys, shards, vnodes, bits, slack=None):
    """Rows one by one in ring order, each to the first shard clockwise with room."""
    h = lambda *parts: _fold(parts)
    points = sorted((h("ring", s, v) >> (64 - bits), s, v) for s in range(shards) for v in range(vnodes))
    n = len(keys)
    caps = [n // shards + (s < n % shards) if slack is None else -int(-(n * (1 + slack) / shards) // 1) for s in range(shards)]
    out, slots = {}, Counter()
    for key in _ring_order(keys, points, bits):
        cell = h(key) >> (64 - bits)
        i = next((i for i, p in enumerate(points) if p[0] >= cell), 0)
        while slots[points[i % len(points)][1]] >= caps[points[i % len(points)][1]]:
            i += 1
        s = points[i % len(points)][1]
        out[key] = s
        slots[s] += 1
    return out


def _ring_order(keys, points, bits):
    last = points[-1][0]
    def place(k):
        cell = _fold((k,)) >> (64 - bits)
        # cells after the last point belong to the first arc, after its own cells
        return (next((i for i, p in enumerate(points) if p[0] >= cell), 0), cell, _signed(_fold((k,))), k)
    return sorted(keys, key=place)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _fold(parts):
    """Spark's xxhash64 of several values: each one's hash seeds the next."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
        if isinstance(p, int) and len(parts) > 1:
            data = p.to_bytes(4, "little", signed=True)  # the ring's numbers are ints
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


@pytest.mark.parametrize("n,shards,vnodes,slack", [(500, 7, 4, None), (333, 5, 8, 0.2), (3, 6, 2, None), (80, 40, 3, 0.0)])
def test_equals_the_sequential_ring(spark, n, shards, vnodes, slack):
    keys = list(range(n))
    df = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    got = {r.doc_id: r.shard for r in sharding.assign(df, shards, vnodes=vnodes, ring_bits=8, slack=slack).collect()}
    assert got == brute(keys, shards, vnodes, 8, slack)


def test_law_slots_and_odd_rows(spark):
    rows = [(i, "é" * (i % 5), "x") for i in range(203)] + [(None, None, "n")] * 30 + [(7, "again", "y")] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard_table(df, 40).collect()
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    want = sorted((str(k), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    assert sharding.shard_table(df.limit(0), 40).count() == 0


def test_one_more_shard_moves_few_rows(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.shard for r in sharding.assign(df, 20, slack=0.25).collect()}
    b = {r.doc_id: r.shard for r in sharding.assign(df, 21, slack=0.25).collect()}
    assert sum(a[k] != b[k] for k in a) < 0.25 * len(a)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = sharding.shard_table(df, 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_key_on_a_third_of_the_rows_is_ranked_in_parts(spark, monkeypatch):
    keys = [7] * 300 + [None] * 100 + list(range(500))
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "doc_id long, n int").repartition(7)
    whole = Counter((r.doc_id, r["shard"]) for r in sharding.assign(df, 9, vnodes=5, ring_bits=8).collect())
    monkeypatch.setattr(sharding, "CELL_ROWS", 20)
    got = sharding.assign(df, 9, vnodes=5, ring_bits=8)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "_ring_part" in plan
    rows = got.collect()
    assert sorted(r.n for r in rows) == list(range(len(keys)))
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    # As many rows of the hot key in each shard; a cell's other keys may change places with it.
    assert sum((whole - Counter((r.doc_id, r["shard"]) for r in rows)).values()) <= 20
    with pytest.raises(ValueError):
        sharding.assign(df.withColumn("slot", df.n), 3)


def test_the_registered_listing_equals_the_sequential_ring(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("text", F.when(F.col("doc_id") == 3, F.repeat("text", F.lit(2000))).otherwise(F.col("text")))
    got = {r.doc_id: r["shard"] for r in sharding.shard_table(df, 40).collect()}
    assert got == brute([r.doc_id for r in df.select("doc_id").collect()], 40, sharding.VNODES, sharding.RING_BITS)
