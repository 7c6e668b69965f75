"""Quality classifier: parts against brute force, held-out accuracy, odd rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from censuskit.llm import quality
from censuskit.llm.words import CLASSES, SOLID, prefix_sums, runs, spans
from tests.conftest import SF01


def test_runs_and_hashes():
    texts = ["ab  c1!!x\né é", "", " ", "ab", "!!"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in raw])
    starts, ends, rows = runs(data, offsets, CLASSES)
    got = [(r, bytes(data[s:e]).decode()) for s, e, r in zip(starts, ends, rows)]
    assert got == [(0, "ab"), (0, "c"), (0, "1"), (0, "!!"), (0, "x"), (0, "é"), (0, "é"), (3, "ab"), (4, "!!")]
    h = spans(prefix_sums(data), starts, ends)
    same = {}
    for (_, w), x in zip(got, h):
        assert same.setdefault(w, x) == x
    assert len(set(same.values())) == len(same)
    assert [bytes(data[s:e]).decode() for s, e, _ in zip(*runs(data, offsets, SOLID))] == ["ab", "c1!!x", "é", "é", "ab", "!!"]


def test_word_vectors_equal_a_loop(spark):
    texts = ["a b c a", "b c", None, "", "d " * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("coalesce(t, '') as text").repartition(3)
    places, signs = quality.index_vectors()
    sums = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    counts = np.zeros(quality.BUCKETS)
    for t in texts:
        ids, _ = quality.bucket_ids(pa.record_batch({"text": [t or ""]}))
        for i, w in enumerate(ids):
            counts[w] += 1
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if j != i:
                    np.add.at(sums[w], places[ids[j]], signs[ids[j]])
    mean = sums / np.maximum(counts, 1)[:, None]
    mean -= sums.sum(0) / counts.sum()
    mean /= np.maximum(np.linalg.norm(mean, axis=1), 1e-9)[:, None]
    weight = np.where(counts > 0, 1e-3 / (1e-3 + counts / counts.sum()), 0)
    assert np.allclose(quality.word_vectors(df) / quality.FIXED, mean * weight[:, None], atol=1 / quality.FIXED)


def test_pooling_equals_a_loop(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-quality.FIXED, quality.FIXED, (quality.BUCKETS, 4)).astype(np.int32)
    batch = pa.record_batch({"text": ["a b a a c", "", "z", "a b c d e f g " * 9, "x x"]})
    ids, rows = quality.bucket_ids(batch)
    whole = quality.pool(batch, vectors)
    monkeypatch.setattr(quality, "WORDS", 3)
    assert (quality.pool(batch, vectors) == whole).all()
    for r in range(5):
        v = vectors[ids[rows == r]] / quality.FIXED
        pairs = v[:-1] * v[1:]
        want = [*(v.sum(0) / max(1, len(v))), *(pairs.sum(0) / max(1, len(v))), np.log1p(len(v))]
        assert np.allclose(whole[r], want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    good = [r.score for r in held if r.quality]
    bad = [r.score for r in held if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.93  # 19 bad rows here; 0.999 at sf0.1


def test_network_temperature_and_scores_equal_loops():
    """Probabilities value by value; the slopes by differences; the temperature
    the best of a fine grid."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.8 * rng.normal(size=120) > 0.3).astype(float)
    held = np.arange(120) % 5 == 0
    model = quality.train(x, y, held, np.zeros((1, 1)))
    w1, b1, w2, b2 = model.layers
    for row, p in zip(x, quality.probabilities(model, x)):
        hidden = [math.tanh(sum((row[i] - model.mean[i]) / model.scale[i] * w1[i, j] for i in range(5)) + b1[j]) for j in range(quality.HIDDEN)]
        z = sum(h * w for h, w in zip(hidden, w2)) + float(b2)
        assert p == pytest.approx(1 / (1 + math.exp(-z / model.temperature)), rel=1e-9)
    z = quality.logits(model, x[held])
    loss = lambda t: sum(math.log1p(math.exp(-v / t if w else v / t)) for v, w in zip(z, y[held])) / held.sum()
    grid = [math.exp(math.log(0.05) + i * math.log(400) / 2000) for i in range(2001)]
    assert loss(model.temperature) <= min(map(loss, grid)) + 1e-9
    # Training lowers its objective to a point where no single weight helps by much.
    def objective(layers):
        own = quality.Model(model.vectors, model.mean, model.scale, layers, 1.0, 0.5)
        v, w = quality.logits(own, x[~held]), y[~held]
        return np.logaddexp(0, np.where(w > 0, -v, v)).mean() + quality.DECAY / (~held).sum() * ((layers[0] ** 2).sum() + (layers[2] ** 2).sum()) / 2
    best = objective(model.layers)
    assert best < 0.6 * math.log(2) + 0.2
    for k in (0, 2):
        for at in [(0, 0), (1, 3), (4, 15)] if k == 0 else [(0,), (9,)]:
            for step in (-0.05, 0.05):
                layers = [w.copy() for w in model.layers]
                layers[k][at] += step
                assert objective(layers) > best - 1e-3
    # Too few kinds of label: the share of good ones.
    assert set(quality.probabilities(quality.train(x, np.ones(120), held, np.zeros((1, 1))), x)) == {1.0}


def test_odd_rows(spark):
    rows = [(i, "good words here and there", 1) for i in range(30)] + [(100 + i, "### %%% $$$ !!", 0) for i in range(30)]
    docs = spark.createDataFrame(rows + [(None, None, 1), (7, "", 0), (7, "", 0), (8, "x" * 300_000, 0)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (0, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 64 and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.doc_id < 100) for r in got if r.doc_id is not None and r.doc_id not in (7, 8))
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} >= set(range(30)) - {7, 8}
    assert quality.score(docs.limit(0), model).count() == 0
    none = quality.fit(docs.limit(0), labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {1.0}
