"""SimHash near-duplicates by a binary trie self-join.

Documents get 64-bit fingerprints; equal fingerprints are one node from there
on. Fingerprints within ``radius`` bits agree in at least one of ``radius + 1``
blocks, so for each block those that share its value form one trie over the
remaining bits. A trie is joined with itself by walking pairs of its nodes
together, adding up the bits in which they differ and dropping a pair as soon
as it spends more than the radius. Big tries are cut into pairs of subtries
first, pruned by the same budget, so no task holds one whole.
"""

from __future__ import annotations

from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, contract
from .shared import cut, shuffle_partitions, slices

SHINGLE = 3
RADIUS = 3
#: Tries with more fingerprints than this are joined as pairs of subtries.
TRIE_ROWS = 20_000
#: Node pairs that a walk widens at a time, and leaf pairs compared at a time.
FRONTIER = 200_000
LEAF = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, length: int) -> list[int]:
    """XXH64 (seed 42) of a text's word shingles, repeats included; of the
    whole sequence if it is shorter; nothing without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return []
    runs = zip(*(islice(words, i, None) for i in range(length))) if len(words) >= length else [words]
    return list(map(partial(xxhash.xxh64_intdigest, seed=42), map(b" ".join, runs)))


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of ``sizes`` hashes, the bits set in over half of them."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(sizes) - sizes)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > sizes[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _bits(part: pa.RecordBatch, shingle: int) -> np.ndarray:
    """The fingerprints of a slice of texts, as signed longs."""
    runs = [shingle_hashes(x, shingle) for x in part.column("text").to_pylist()]
    sizes = np.array([len(x) for x in runs], np.int64)
    flat = np.fromiter((h for x in runs for h in x), np.uint64, int(sizes.sum()))
    return majority(flat, sizes).view(np.int64)


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key`` and ``bits`` (the fingerprint as a signed long) of every row;
    a null text or one without words has fingerprint zero."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(_bits(part, shingle))], ["key", "bits"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, bits long").withColumnRenamed("key", key)


def walk(keys: np.ndarray, a0, a1, b0, b1, top: int, radius: int):
    """Pairs of positions in ``keys`` within ``radius`` bits, below the node
    pairs [a0, a1) x [b0, b1); equal ranges are a node with itself. Keys are
    sorted in each range and agree above bit ``top`` but for what the caller
    has already sorted out (differing bits above ``top`` count, too)."""
    high = np.uint64(0) if top >= 63 else ~np.uint64((1 << (top + 1)) - 1)
    spent = np.bitwise_count((keys[a0] ^ keys[b0]) & high).astype(np.int64)
    ones = {}
    stack = [(top, a0, a1, b0, b1, spent)]
    while stack:
        bit, a0, a1, b0, b1, spent = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack.append((bit, a0[half:], a1[half:], b0[half:], b1[half:], spent[half:]))
            a0, a1, b0, b1, spent = a0[:half], a1[:half], b0[:half], b1[:half], spent[:half]
            stack.append((bit, a0, a1, b0, b1, spent))
            continue
        small = (a1 - a0) * (b1 - b0) <= LEAF if bit >= 0 else np.ones(len(a0), bool)
        if small.any():
            yield from _leaves(keys, a0[small], a1[small], b0[small], b1[small], radius)
            a0, a1, b0, b1, spent = (x[~small] for x in (a0, a1, b0, b1, spent))
        if not len(a0):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        c = ones[bit]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        apart = (a0 != b0) | (a1 != b1)
        kids = [
            (a0, am, b0, bm, spent), (am, a1, bm, b1, spent), (a0, am, bm, b1, spent + 1),
            tuple(x[apart] for x in (am, a1, b0, bm, spent + 1)),  # of a node with itself this is the third again
        ]
        new = [np.concatenate(x) for x in zip(*kids)]
        keep = (new[0] < new[1]) & (new[2] < new[3]) & (new[4] <= radius)
        stack.append((bit - 1, *(x[keep] for x in new)))


def _leaves(keys, a0, a1, b0, b1, radius):
    """Compares all pairs below small node pairs, a bounded number at a time."""
    sizes = (a1 - a0) * (b1 - b0)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(a0):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 4 * FRONTIER, side="right")))
        n = sizes[start:stop]
        which = np.repeat(np.arange(start, stop), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[which]
        i, j = a0[which] + at // width, b0[which] + at % width
        keep = (np.bitwise_count(keys[i] ^ keys[j]) <= radius) & (keys[i] != keys[j])
        yield i[keep], j[keep]
        start = stop


def _join_tries(batches, radius: int, block_bits: int):
    """Rows sorted by (trie, side, key): links within each trie (side 0
    alone) or between its two sides, contracted per batch of whole tries."""
    names = ["block", "value", "low", "high", "side", "turned"]
    held: list[np.ndarray] | None = None

    def links(columns, top):
        block, value, low, high, side, turned = columns
        group = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
        ends = np.append(group[1:], len(block))
        sides = np.concatenate([[0], np.cumsum(side, dtype=np.int64)])
        mid = ends - (sides[ends] - sides[group])
        cross = low[group] != high[group]
        keys = turned.view(np.uint64)
        out = ([], [])
        for kind, first, last in ((~cross, group, ends), (cross, mid, ends)):
            use = kind & (first < last) & (group < ends) & ((group < mid) | ~kind | ~cross)
            if use.any():
                for i, j in walk(keys, group[use], np.where(cross, mid, ends)[use], first[use], last[use], top, radius):
                    if len(i):
                        r = (block[i].astype(np.uint64) * np.uint64(block_bits)) & np.uint64(63)
                        back = (np.uint64(64) - r) & np.uint64(63)
                        for k, at in enumerate((i, j)):
                            out[k].append(((keys[at] >> r) | (keys[at] << back)).view(np.int64))
        if out[0]:
            node, root = contract(np.concatenate(out[0]), np.concatenate(out[1]))
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])
        return None

    top = 63 - block_bits
    for batch in batches:
        new = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        last = [x[-1] for x in held[:4]]
        same = np.logical_and.reduce([x == y for x, y in zip(held[:4], last)])
        whole = len(same) - int(same.sum())
        if whole >= 10_000:
            if (found := links([x[:whole] for x in held], top)) is not None:
                yield found
            held = [x[whole:] for x in held]
    if held is not None and len(held[0]) and (found := links(held, top)) is not None:
        yield found


def trie_links(nodes: DataFrame, radius: int = RADIUS, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """Links ``(node, root)`` that connect all ``bits`` (distinct longs) within
    ``radius`` differing bits; contracted, so as many at most as rows come in
    per block and task, not as pairs exist."""
    blocks = radius + 1
    width = 64 // blocks
    turned = [F.expr(f"(shiftleft(bits, {i * width}) | shiftrightunsigned(bits, {64 - i * width}))") if i else F.col("bits") for i in range(blocks)]
    rows = nodes.select(F.explode(F.array(*[F.struct(F.lit(i).alias("block"), t.alias("turned")) for i, t in enumerate(turned)])).alias("x")).select(
        "x.block", "x.turned", F.shiftrightunsigned("x.turned", 64 - width).alias("value")
    )
    # Tries over the bound: their subtries by the next 8 bits, in pairs that
    # differ in at most ``radius`` of these.
    big = rows.groupBy("block", "value").count().where(F.col("count") > trie_rows).select("block", "value", F.lit(True).alias("big"))
    rows = rows.join(big, ["block", "value"], "left")
    sub = F.shiftrightunsigned("turned", 64 - width - 8).bitwiseAND(F.lit(255)).cast("int")
    near = [m for m in range(256) if bin(m).count("1") <= radius]
    pairs = rows.where("big").select(
        "block", "value", "turned", sub.alias("own"), F.explode(F.transform(F.array(*map(F.lit, near)), lambda m: sub.bitwiseXOR(m))).alias("other")
    ).select("block", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "turned")
    whole = rows.where("big is null").select("block", "value", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side"), "turned")
    tries = ["block", "value", "low", "high"]
    dealt = whole.unionByName(pairs).repartition(shuffle_partitions(nodes.sparkSession), *tries)
    # Within a trie the sign bit agrees, so the signed order is the order by bits.
    dealt = dealt.sortWithinPartitions(*tries, "side", "turned")
    return dealt.mapInArrow(lambda batches: _join_tries(batches, radius, width), "node long, root long")


def groups(prints: DataFrame, key: str, radius: int, trie_rows: int) -> DataFrame:
    """Per fingerprint of ``prints``: ``bits``, ``first`` (its smallest key) and
    ``root``, the same for all fingerprints that links connect."""
    nodes = cut(prints.groupBy("bits").agg(F.min(key).alias("first")), "nodes")
    roots = components(trie_links(nodes, radius, trie_rows))
    return nodes.join(roots, F.col("bits") == F.col("node"), "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest
    key that links of at most ``radius`` differing bits reach, its own
    included) of every row of ``df``.

    Null and empty texts have fingerprint zero and link like any other; a null
    key is never the smallest unless its whole component has none. Repeated
    rows stay repeated. Very long texts are hashed whole, one at a time. Other
    columns are not read, so none can clash. No rows, no result.
    """
    prints = cut(fingerprints(df, key, text, shingle), "fingerprints")
    own = groups(prints, key, radius, trie_rows)
    lowest = own.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = own.join(lowest, "root").select("bits", "component_id")
    return prints.join(classes, "bits").select(key, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """One row of ``df``, all columns, for each group of ``near_duplicates``:
    one with the group's smallest key; of repeated rows any one, and a null key
    only where a group has no other. Null and empty texts are one group. Columns
    that begin with ``_simhash`` would clash. No rows, none back."""
    at, kind = df.columns.index(text), df.schema.simpleString()[7:-1]

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.compute.fill_null(batch.column(at), "").cast(pa.binary())], ["text"])
            bits = np.concatenate([_bits(part, shingle) for part in slices(texts, "text")]) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits)], [*batch.schema.names, "_simhash_bits"])

    marked = cut(df.mapInArrow(run, f"{kind},_simhash_bits:bigint"), "marked")
    own = groups(marked.select(key, F.col("_simhash_bits").alias("bits")), key, radius, trie_rows)
    keep = own.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "bits")).alias("x")).select(
        F.col("x.first").alias("_simhash_first"), F.col("x.bits").alias("_simhash_own")
    )
    chosen = marked.join(keep, marked[key].eqNullSafe(F.col("_simhash_first")) & (F.col("_simhash_bits") == F.col("_simhash_own")), "left_semi")
    return chosen.dropDuplicates([key, "_simhash_bits"]).select(*df.columns)
