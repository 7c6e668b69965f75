"""Quality scores: random-indexing word vectors, a small network, calibration.

Every word bucket has a fixed sparse random index vector; a bucket's word
vector is the sum of the index vectors of its neighbours over the whole corpus
(integers, added up in two steps), centred and scaled. A document pools
its words' weighted vectors. A two-layer numpy network learns labels
from a bounded sample of labelled rows, and a temperature fitted on rows set
aside from training makes its outputs probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filter_texts, raw_bytes, shuffle_partitions, slices
from .words import CLASSES, mix, prefix_sums, runs, spans

#: Word buckets (hashed words), vector length, entries of an index vector,
#: neighbours on each side.
BUCKETS = 1 << 15
DIMENSIONS = 32
ENTRIES = 2
REACH = 2
#: Vectors are whole multiples of 1 / FIXED; words pooled at a time.
FIXED = 1 << 15
WORDS = 1 << 16
#: Buckets that travel as one row.
CHUNK = 128
#: Labelled rows that the network learns from at most.
SAMPLE = 20_000
HIDDEN = 16
EPOCHS = 400
#: Weight decay, as a count of rows.
DECAY = 1.0
THRESHOLD = 0.7


@dataclass
class Model:
    vectors: np.ndarray  # of each bucket, weighted
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple | None  # None: too few labels, every score is ``prior``
    temperature: float
    prior: float


def bucket_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word of a slice, in order."""
    data, offsets = raw_bytes(batch.column("text"))
    starts, ends, rows = runs(data, offsets, CLASSES)
    return (spans(prefix_sums(data), starts, ends) % np.uint64(BUCKETS)).astype(np.int64), rows


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector."""
    draw = mix(np.arange(1, BUCKETS * ENTRIES + 1, dtype=np.uint64)).reshape(BUCKETS, ENTRIES)
    return (draw % np.uint64(DIMENSIONS)).astype(np.int64), np.where(draw >> np.uint64(63), 1, -1).astype(np.int32)


def _gather(batches):
    """Sums of one task: a row of ``CHUNK`` buckets with a count and a vector."""
    width = DIMENSIONS + 1
    places, signs = index_vectors()
    sums = np.zeros(BUCKETS * width, np.int32)
    seen = False
    for batch in batches:
        for part in slices(batch, "text"):
            ids, rows = bucket_ids(part)
            seen = seen or len(ids) > 0
            np.add.at(sums, ids * width + DIMENSIONS, np.int32(1))
            for reach in range(1, REACH + 1):
                near = rows[reach:] == rows[:-reach]
                left, right = ids[:-reach][near], ids[reach:][near]
                for word, other in ((left, right), (right, left)):
                    for e in range(ENTRIES):
                        np.add.at(sums, word * width + places[other, e], signs[other, e])
    if seen:
        chunks = sums.reshape(-1, CHUNK * width)
        full = np.flatnonzero(chunks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array([chunks[i].astype("<i8").tobytes() for i in full], pa.binary())], ["chunk", "sums"]
        )


def _add(batches):
    """Adds up the rows of each chunk that meet in a task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("sums")):
            new = np.frombuffer(data.as_buffer(), "<i8")
            total[chunk] = total[chunk] + new if chunk in total else new.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["chunk", "sums"])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The vectors of all buckets, weighted for pooling, in units of 1 / FIXED. What comes to the
    driver is the model itself, ``BUCKETS`` rows whatever the corpus."""
    kind = "chunk int, sums binary"
    parts = texts.mapInArrow(_gather, kind).withColumn("salt", F.spark_partition_id() % 16)
    n = min(shuffle_partitions(texts.sparkSession), 64)
    some = parts.repartition(n, "chunk", "salt").select("chunk", "sums").mapInArrow(_add, kind)
    rows = some.repartition(n, "chunk").mapInArrow(_add, kind).collect()
    sums = np.zeros((BUCKETS, DIMENSIONS + 1))
    for chunk, data in rows:
        sums[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(data, "<i8").reshape(CHUNK, -1)
    counts, vectors = sums[:, -1], sums[:, :-1]
    if not counts.any():
        return np.zeros((BUCKETS, DIMENSIONS), np.int32)
    vectors = vectors / np.maximum(counts, 1)[:, None]
    vectors -= (vectors * counts[:, None]).sum(0) / counts.sum()
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
    share = counts / counts.sum()
    weight = np.where(counts > 0, 1e-3 / (1e-3 + share), 0)  # frequent words count less
    return np.rint(vectors * weight[:, None] * FIXED).astype(np.int32)


def pool(batch: pa.RecordBatch, vectors: np.ndarray) -> np.ndarray:
    """Each row's words pooled: their mean vector, the mean product of
    neighbours' vectors (words that repeat agree with themselves), and the log
    of one more than their number. All zero without words. Sums are integers,
    so a row's values don't depend on its slice; words go a block at a time."""
    ids, rows = bucket_ids(batch)
    n = vectors.shape[1]
    sums = np.zeros((batch.num_rows, 2 * n), np.int64)
    for low in range(0, len(ids), WORDS):
        own = rows[low : low + WORDS]
        each = vectors[ids[low : low + len(own) + 1]]
        here = each[: len(own)]
        with_next = np.zeros_like(here)
        m = len(each) - 1
        with_next[:m] = here[:m] * each[1:]
        with_next[:m][rows[low : low + m] != rows[low + 1 : low + m + 1]] = 0
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sums[own[starts], :n] += np.add.reduceat(here, starts, axis=0, dtype=np.int64)
        sums[own[starts], n:] += np.add.reduceat(with_next, starts, axis=0, dtype=np.int64)
    count = np.bincount(rows, minlength=batch.num_rows)
    means = sums / np.repeat([FIXED, FIXED**2], n) / np.maximum(count, 1)[:, None]
    return np.hstack([means, np.log1p(count)[:, None]])


def logits(model: Model, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = model.layers
    return np.tanh((x - model.mean) / model.scale @ w1 + b1) @ w2 + b2


def probabilities(model: Model, x: np.ndarray) -> np.ndarray:
    if model.layers is None:
        return np.full(len(x), model.prior)
    return 1 / (1 + np.exp(-np.clip(logits(model, x) / model.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, held: np.ndarray, vectors: np.ndarray, seed: int = 7) -> Model:
    """Fits the network on the rows not ``held`` and the temperature on those
    that are. With fewer than two kinds of label in either part there is no
    network, and every score is (good + 1) / (labelled + 1): 1 without labels."""
    prior = float((y.sum() + 1) / (len(y) + 1))
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(1), np.ones(1))
    if any(len(set(y[part].tolist())) < 2 for part in (held, ~held)):
        return Model(vectors, mean, scale, None, 1.0, prior)
    rng = np.random.default_rng(seed)
    decay = DECAY / (~held).sum()
    fit, want = (x[~held] - mean) / scale, y[~held]
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, EPOCHS + 1):  # Adam on all rows
        hidden = np.tanh(fit @ layers[0] + layers[1])
        out = 1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -500, 500)))
        error = (out - want) / len(want)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [fit.T @ back + decay * layers[0], back.sum(0), hidden.T @ error + decay * layers[2], error.sum()]
        for i, g in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            layers[i] = layers[i] - 0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, tuple(layers), 1.0, prior)
    z, want = logits(model, x[held]), y[held]

    def loss(t):
        return np.logaddexp(0, np.where(want > 0, -z, z) / t).mean()

    low, high = np.log(0.05), np.log(20.0)  # golden-section search for the temperature
    ratio = (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
    model.temperature = float(np.exp((low + high) / 2))
    return model


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def held_out(key: str) -> F.Column:
    """Rows whose labels are for judging only."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Word vectors of all texts of ``df`` and a network for ``labels``.

    Labels of held-out rows are not read; a key whose labels disagree, and null
    keys and labels, teach nothing. At most ``sample`` labelled keys are used,
    those with the smallest hashes; of rows that repeat a key one teaches (the
    smallest pooled vector). Null texts are empty; very long ones are read whole,
    ``WORDS`` words at a time. Without texts, or without both labels, every score
    is the same (see ``train``). Other columns are not read, so none can clash.
    """
    vectors = word_vectors(_texts(df, key, text).select("text"))
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
        .groupBy(F.col(key).alias("key")).agg(F.min(label).alias("y"), F.max(label).alias("y1")).where("y = y1").select("key", "y")
        .orderBy(F.xxhash64("key"), "key").limit(sample)
    )
    shared = df.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = pool(part, shared.value)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["key", "y", "x"])

    kinds = f"key {df.schema[key].dataType.simpleString()}, y int, x array<double>"
    # ``known`` has at most ``sample`` rows, so it may be broadcast.
    found = _texts(df, key, text).join(F.broadcast(known.withColumn("y", F.col("y").cast("int"))), "key").select("key", "y", "text").mapInArrow(run, kinds)
    rows = found.groupBy("key").agg(F.min("y").alias("y"), F.min("x").alias("x")).orderBy("key").collect()
    x = np.array([r.x for r in rows], float).reshape(len(rows), 2 * DIMENSIONS + 1)
    y = np.array([r.y for r in rows], float)
    aside = np.arange(len(rows)) % 5 == 0
    return train(x, y, aside, vectors)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``held_out``, ``score`` (probability of label 1) and
    ``predicted`` (1 from ``threshold`` up) of every row. A null text is an
    empty one, which pools to zero; a null key is not held out. A score depends
    on its text and the model alone: repeated rows score alike, equal texts tie,
    very long texts are pooled whole. Other columns are not read, so none can
    clash. No rows, none back."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                p = probabilities(shared.value, pool(part, shared.value.vectors))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(p)], ["key", "score"])

    kind = df.schema[key].dataType.simpleString()
    rows = _texts(df, key, text).mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
    return rows.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, all columns, whose texts score at least ``threshold``.
    Null and empty texts score as in ``score`` and stay or go by that; repeated
    rows fare alike; no column is added. No rows, none back."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return filter_texts(df, text, lambda: lambda part: probabilities(shared.value, pool(part, shared.value.vectors)) >= threshold)
