"""Exact substring deduplication against a table of every window."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from censuskit.llm import suffixes
from tests.conftest import SF001, SF01


def brute(rows, length):
    """Kept bytes, removed bytes and runs by (key, text)."""
    seen, out = {}, {}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for k, t in order:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            else:
                seen[w] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        out[k, t] = (len(data), int(gone.sum()), runs, bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


def check(spark, rows, length, gram, parts=5):
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, kept string").repartition(parts)
    got = suffixes.deduplicate(df, length=length, gram=gram).collect()
    want = brute(rows, length)
    assert sorted((str(r.doc_id), *r[1:4], bytes(r.kept)) for r in got) == sorted((str(k), *want[k, t]) for k, t in rows)
    return want


@pytest.mark.parametrize("length,gram,letters", [(12, 4, "ab"), (12, 4, "abcdefgh"), (20, 8, "abé"), (100, 24, "abcdefghij ")])
def test_equals_every_window(spark, length, gram, letters):
    rng = random.Random(length)
    pieces = ["".join(rng.choice(letters) for _ in range(rng.randint(length // 2, 3 * length))) for _ in range(12)]
    rows = []
    for d in rng.sample(range(1000), 80):
        text = "".join(rng.choice(pieces)[rng.randint(0, 9) :] + "".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6)))
        rows.append((d, text))
    rows += [(2000, None), (2001, ""), (2002, "a" * (5 * length)), (2003, "a" * (length - 1)), (None, pieces[0] * 2), (rows[0][0], rows[0][1]), (2004, rows[1][1]), (2005, rows[1][1])]
    want = check(spark, rows, length, gram)
    assert sum(x[1] for x in want.values()) > 0


def test_small_batches_make_many_levels(spark, monkeypatch):
    index, rng = suffixes.LogIndex(), np.random.default_rng(1)
    known: dict[int, int] = {}
    for _ in range(40):
        key = np.unique(rng.integers(0, 3000, 100))
        level, place = index.scan(key)
        assert [(k in known) for k in key.tolist()] == (level >= 0).tolist()
        assert all(index.levels[n][0][p] == k and index.levels[n][1][p] == known[k] for k, n, p in zip(key.tolist(), level, place) if n >= 0)
        fresh = key[level < 0]
        known.update((k, k * 7) for k in fresh.tolist())
        index.add(fresh, fresh * 7)
        sizes = [len(x[0]) for x in index.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 13


def test_same_key_different_content():
    index = suffixes.LogIndex()
    index.add(np.array([1, 1, 1, 5]), np.array([7, 8, 9, 7]))
    level, _ = index.scan(np.array([1, 1, 1, 5, 5, 6]), np.array([7, 9, 10, 7, 8, 7]))
    assert (level >= 0).tolist() == [True, True, False, True, False, False]


def test_texts_of_one_key_that_share_a_short_hash(spark):
    """Texts whose 32-bit hashes clash are two documents under one key, and
    under none: only the one that is repeated loses bytes."""
    many = spark.range(250_000).selectExpr("concat(sha2(string(id), 512), if(id % 2 = 0, sha2(string(-id - 1), 512), '')) AS text")
    short = many.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).where("size(texts) > 1")
    pairs = sorted(sorted(r.texts, key=lambda t: (-len(t), t))[:2] for r in short.collect())
    assert len(pairs) > 1
    rows = []
    for n, (a, b) in enumerate(pairs):
        rows += [(n, a), (1000 + n, a), (1000 + n, b)] if n % 2 else [(n, a), (None, a), (None, b)]
    want = check(spark, rows, 100, 24)
    assert sum(x[1] for x in want.values()) == sum(len(a) for a, _ in pairs)
    # One text under another's shared stretch: the windows are looked up singly.
    rows = [(0, "x" * 30 + pairs[0][0]), (1, pairs[0][0][:110] + "y" * 60), (5, pairs[0][0]), (5, pairs[0][1])]
    assert check(spark, rows, 100, 24)[5, pairs[0][1]][1] == 0


def test_documents(spark):
    for folder in (SF001, SF01):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        if folder == SF01:
            rows = rows[:400]
        want = check(spark, rows, 100, 24, parts=6)
        assert sum(x[1] for x in want.values()) > 0
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert suffixes.report(df.limit(0)).count() == 0
    assert suffixes.report(df).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_rows_alike_are_worked_out_once_and_long_texts_whole(spark, monkeypatch):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    own = text(400)
    rows = [(None, None)] * 120 + [(5, own)] * 90 + [(i, own[:200] + text(50)) for i in range(10, 40)] + [(99, text(300_000) + own)]
    monkeypatch.setattr(suffixes, "PART_BYTES", 20_000)  # many parts
    want = check(spark, rows, 100, 24)
    assert want[99, rows[-1][1]][1] == 400
    plan = suffixes.report(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc" not in plan
    for length in (1 << 16, 10):
        with pytest.raises(ValueError):
            suffixes.report(spark.createDataFrame(rows, "doc_id long, text string"), length=length)
