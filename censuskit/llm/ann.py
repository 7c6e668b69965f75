"""Nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; a cell is
a pair of centroids. A query ranks the centroids of each half by inner product
and walks the pairs by their sum with a heap until the cells it has passed hold
enough entries. The index is dealt out in parts of whole cells (big cells in
pieces) and the queries in blocks; part and block meet, both of bounded size,
and the entries of the cells that a query has passed are ranked again by the
inner product of the original vectors.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

#: Rows that the codebooks are fitted on at most, and centroids a half.
SAMPLE = 20_000
CENTROIDS = 64
#: Share of the entries, and least number, that a query's cells hold together.
#: Vectors without structure leave an index little to prune: the share is what
#: keeps recall up at every size.
SHARE = 0.5
LEAST = 2_000
#: Entries of a cell that stay together, entries of a part, queries of a block
#: (the last two on average: rows are dealt out by hashes).
PIECE = 512
PART = 4_096
ASKED = 4_096


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=len(centres))
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None] - 2 * x @ centres.T, axis=1)


def cells_in_order(first: np.ndarray, second: np.ndarray):
    """Pairs (i, j) by falling ``first[i] + second[j]``, by a heap over the
    sorted halves."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap, seen = [(-(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (-(first[a[p]] + second[b[q]]), p, q))


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed left to right, so that equal
    vectors get equal scores wherever they stand."""
    out = np.zeros((len(queries), len(vectors)))
    for d in range(queries.shape[1]):
        out += queries[:, d, None] * vectors[None, :, d]
    return out


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part: not null, not
    zero, no null or non-finite component."""
    v = F.col("v")
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull())
    return rows.where(
        F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    )


def search(df: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", share: float = SHARE, least: int = LEAST, sample: int = SAMPLE, centroids: int = CENTROIDS) -> DataFrame:
    """For each row of ``queries``, its ``k`` nearest found rows of ``df`` by
    largest inner product: ``query_id``, ``rank`` (from 1), ``vec_id``,
    ``score``; ties go to the smaller id.

    Both tables have ``key`` and ``vector``. Vectors that are null, zero or hold
    null or non-finite components take no part, nor do null keys, nor vectors of
    another length than most of ``df`` (the shorter, if several are as common).
    Other columns are not read, so none can clash; an empty table finds nothing. A query does not find rows with its own key. Repeated candidate rows
    count once each; repeated query rows are answered once. All rows of ``df``
    are indexed; only the codebooks are fitted on at most ``sample`` rows (the
    smallest key hashes). With ``k`` entries or fewer beside it, a query finds
    all.
    """
    spark = df.sparkSession
    rows = usable(df, key, vector)
    schema = "query_id long, rank int, vec_id long, score double"
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], schema)
    size = common.size
    rows, asked = (x.where(F.size("v") == size) for x in (rows, usable(queries, key, vector)))
    x = np.array([r.v for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()])
    half = size // 2
    books = spark.sparkContext.broadcast([kmeans(h, centroids) for h in (x[:, :half], x[:, half:])])

    def place(batches):
        for batch in batches:
            v = _vectors(batch.column("v"), size)
            first, second = books.value
            cell = nearest(v[:, :half], first) * len(second) + nearest(v[:, half:], second)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell.astype(np.int32))], ["id", "v", "cell"])

    # Rows are numbered as they are written, so that those of one key can be dealt to different parts.
    placed = cut(rows.mapInArrow(place, "id long, v array<double>, cell int").withColumn("row", F.monotonically_increasing_id()), "placed")
    asked = cut(asked.groupBy("id").agg(F.min("v").alias("v")), "queries")
    counts = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}  # at most centroids**2 rows
    total, n_asked = sum(counts.values()), asked.count()
    want = max(least, int(np.ceil(share * total)), 2 * k)
    parts, asked_blocks = -(-total // PART), max(1, -(-n_asked // ASKED))
    pieces = {c: -(-n // PIECE) for c, n in counts.items()}
    spark_pieces = F.broadcast(spark.createDataFrame(list(pieces.items()), "cell int, pieces int"))  # at most centroids**2 rows
    sizes = spark.sparkContext.broadcast(counts)

    def visit(batches):
        first, second = books.value
        counts = sizes.value
        for batch in batches:
            out = ([], [], [], [])
            v = _vectors(batch.column("v"), size)
            for n, (a, b) in enumerate(zip(v[:, :half] @ first.T, v[:, half:] @ second.T)):
                held, passed = 0, {}
                for i, j in cells_in_order(a, b):
                    cell = i * len(second) + j
                    if cell in counts:
                        for piece in range(-(-counts[cell] // PIECE)):
                            passed.setdefault(part_of(cell, piece, parts), set()).add(cell)
                        held += counts[cell]
                        if held >= want:
                            break
                for part, cells in passed.items():
                    out[0].append(n)
                    out[1].append(part)
                    out[2].append(sorted(cells))
            at = pa.array(out[0], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("v").take(at), pa.array(out[1], pa.int32()), pa.array(out[2], pa.list_(pa.int32()))],
                ["id", "v", "part", "cells"],
            )

    def rank(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            right = right.sort_by([("cell", "ascending"), ("id", "ascending")])
            ids, cells = right.column("id").to_numpy(), right.column("cell").to_numpy()
            v, q = (_vectors(x.column("v").combine_chunks(), size) for x in (right, left))
            own, lists = left.column("id").to_numpy(), left.column("cells").combine_chunks()
            visits = np.column_stack([lists.flatten().to_numpy(), np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))])
            visits = visits[np.argsort(visits[:, 0], kind="stable")]
            starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            by_id = np.argsort(ids, kind="stable")  # columns in the order of ids, for ties
            place = np.empty(len(ids), np.int64)
            place[by_id] = np.arange(len(ids))
            for low in range(0, len(own), 1024):
                high = min(low + 1024, len(own))
                scores = np.full((high - low, len(ids)), -np.inf)
                for s, e in zip(starts, np.append(starts[1:], len(cells))):
                    a, b = np.searchsorted(visits[:, 0], [cells[s], cells[s] + 1])
                    who = visits[a:b, 1]
                    who = who[(who >= low) & (who < high)]
                    if len(who):
                        scores[np.ix_(who - low, place[s:e])] = inner_products(q[who], v[s:e])
                scores[own[low:high, None] == ids[by_id][None]] = -np.inf
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                top = np.take_along_axis(scores, best, 1)
                found = np.isfinite(top)
                for column, x in zip(out, (np.repeat(own[low:high], found.sum(1)), ids[by_id][best[found]], top[found])):
                    column.append(x)
        kinds = (np.int64, np.int64, np.float64)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, kinds)))))

    piece = F.pmod(F.xxhash64("row"), F.col("pieces").cast("long"))
    index = placed.join(spark_pieces, "cell").select(
        "id", "v", "cell", _part(F.col("cell"), piece, parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))).alias("block")
    )
    calls = asked.mapInArrow(visit, "id long, v array<double>, part int, cells array<int>").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(asked_blocks)).cast("int"))
    met = calls.groupBy("part", "block").cogroup(index.groupBy("part", "block"))
    near = met.applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def part_of(cell: int, piece: int, parts: int) -> int:
    """The part of the index that holds a piece of a cell."""
    return (cell * 7919 + piece * 104729) % parts


def _part(cell, piece, parts: int):
    return ((cell.cast("long") * 7919 + piece * 104729) % parts).cast("int")
