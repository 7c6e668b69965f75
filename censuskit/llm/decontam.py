"""Benchmark decontamination by SimHash windows.

A benchmark item is looked for in windows of its own size in words. Windows and
items get SimHash fingerprints of their weighted shingles (a shingle weighs as
much as it has letters and digits). A multi-index over ``radius + 1`` blocks of
the item fingerprints finds every item within ``radius`` bits of a window, and
the exact weighted similarity of the two shingle lists decides.

Only windows that share a shingle with some item are fingerprinted: others have
similarity zero. Documents never move; what is sent to them is a block of items
of bounded size, and a larger benchmark goes in several blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, filter_texts, raw_bytes, slices
from .words import CLASSES, LOWER, mix, prefix_sums, runs, spans

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits that an item and a window may have. At similarity 0.8 about
#: 10 differ, give or take 3.
RADIUS = 18
#: Bytes of benchmark text that are sent to the documents at a time.
ITEM_BYTES = 16 << 20

#: Letters and digits are words, everything else separates.
WORD = np.where((CLASSES == 1) | (CLASSES == 2), 1, 0).astype(np.uint8)
_FILTER_BITS = 20


def words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, length and row of each word, A-Z in lower case."""
    data, offsets = raw_bytes(batch.column("text"))
    data = LOWER[data]
    starts, ends, rows = runs(data, offsets, WORD)
    return spans(prefix_sums(data), starts, ends), ends - starts, rows


def shingles(words: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of every run of ``n`` words."""
    m = max(0, len(words) - n + 1)
    h, w = np.zeros(m, np.uint64), np.zeros(m, np.int64)
    for i in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + m])
        w += lengths[i : i + m]
    return h, w


def signed_bits(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Each shingle's weight, times 1 or -1 by the bits of its hash."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    return (2 * bits - 1) * w[:, None]


def pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingles, repeats included."""
    keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    weight = np.zeros(len(keys), np.int64)
    weight[at] = np.concatenate([wa, wb])
    ca, cb = (np.bincount(x, minlength=len(keys)) for x in (at[: len(a)], at[len(a) :]))
    whole = (weight * np.maximum(ca, cb)).sum()
    return float((weight * np.minimum(ca, cb)).sum() / whole) if whole else 0.0


@dataclass
class Items:
    """A block of benchmark items that share their shingle length."""

    shingle: int
    ids: np.ndarray
    sizes: np.ndarray  # in words
    bits: np.ndarray  # fingerprints
    hashes: list[np.ndarray]
    weights: list[np.ndarray]

    def __post_init__(self):
        every, owners = np.concatenate(self.hashes), np.repeat(np.arange(len(self.hashes)), [len(x) for x in self.hashes])
        order = np.lexsort((owners, every))
        every, owners = every[order], owners[order]
        new = np.concatenate([[True], (every[1:] != every[:-1]) | (owners[1:] != owners[:-1])])
        every, self.owners = every[new], owners[new]
        self.known, self.starts = np.unique(every, return_index=True)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def index(self, radius: int) -> list[tuple[int, int, dict[int, np.ndarray]]]:
        """The multi-index: per block its place, its width and the items by value."""
        out, at = [], 0
        for k in range(radius + 1):
            width = 64 // (radius + 1) + (k < 64 % (radius + 1))
            values = (self.bits >> np.uint64(at)) & np.uint64((1 << width) - 1)
            out.append((at, width, {int(v): np.flatnonzero(values == v) for v in np.unique(values)}))
            at += width
        return out

    def holding(self, hashes: np.ndarray) -> np.ndarray:
        """Items that hold any of these shingles."""
        at = np.searchsorted(self.known, hashes)
        ends = np.append(self.starts[1:], len(self.owners))
        return np.unique(np.concatenate([self.owners[self.starts[i] : ends[i]] for i in at])) if len(at) else at


def item_rows(part: pa.RecordBatch, shingle: int):
    """Of a slice of items: for each with words its row, shingle length (shorter
    items are one shingle), words, fingerprint, shingles and their weights."""
    words, lengths, rows = words_of(part)
    ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
    for r in np.flatnonzero(np.diff(ends)).tolist():
        own = slice(ends[r], ends[r + 1])
        size = int(ends[r + 1] - ends[r])
        n = min(shingle, size)
        h, w = shingles(words[own], lengths[own], n)
        yield r, n, size, int(pack(signed_bits(h, w).sum(0)[None])[0]), h, w


def make_items(table: pa.Table) -> list[Items]:
    """Blocks by shingle length from rows of ``prepared`` items."""
    out = []
    ids, n, size, bits = (table.column(c).to_numpy(zero_copy_only=False) for c in ("item", "n", "size", "bits"))
    hashes, weights = ([x.values.to_numpy() for x in table.column(c)] for c in ("hashes", "weights"))
    for length in np.unique(n).tolist():
        at = np.flatnonzero(n == length)
        out.append(Items(length, ids[at], size[at], bits[at].view(np.uint64), [hashes[i].view(np.uint64) for i in at], [weights[i] for i in at]))
    return out


def matches(items: Items, index, words, lengths, radius: int, least: float):
    """(item, start word, words, bits, similarity) of the best window of each
    item that a document holds; the first of equals."""
    h, w = shingles(words, lengths, items.shingle)
    if not len(h):
        return
    hits = np.flatnonzero(items.maybe[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    hits = hits[np.isin(h[hits], items.known)]
    if not len(hits):
        return
    best: dict[int, tuple] = {}
    sizes = np.unique(items.sizes[items.holding(np.unique(h[hits]))])
    for size in sizes:
        window = min(int(size), len(words))
        span = window - items.shingle + 1  # shingles of a window
        # Windows with a hit: starts in (hit - span, hit].
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, np.maximum(hits - span + 1, 0), 1)
        np.add.at(edge, hits + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge)[: len(h) - span + 1] > 0)
        for low in range(0, len(starts), 4096):
            part = starts[low : low + 4096]
            first = part[0]
            sums = np.zeros((part[-1] + span - first + 1, 64), np.int64)
            np.cumsum(signed_bits(h[first : part[-1] + span], w[first : part[-1] + span]), axis=0, out=sums[1:])
            prints = pack(sums[part + span - first] - sums[part - first])
            right = items.sizes == size
            found: set[tuple[int, int]] = set()
            for at, width, table in index:
                values = (prints >> np.uint64(at)) & np.uint64((1 << width) - 1)
                for v in np.unique(values).tolist():
                    if (own := table.get(v)) is not None and len(own := own[right[own]]):
                        here = np.flatnonzero(values == v)
                        near = np.bitwise_count(prints[here][:, None] ^ items.bits[own][None]) <= radius
                        found.update((int(here[a]), int(own[b])) for a, b in zip(*np.nonzero(near)))
            for a, i in sorted(found):
                start = int(part[a])
                score = similarity(h[start : start + span], w[start : start + span], items.hashes[i], items.weights[i])
                if score >= least and (i not in best or score > best[i][3]):
                    best[i] = (start, window, int(np.bitwise_count(prints[a] ^ items.bits[i])), score)
    for i, x in sorted(best.items()):
        yield (items.ids[i], *x)


def scan(part: pa.RecordBatch, groups: list, radius: int, least: float) -> list[tuple]:
    """Matches of a slice of texts, each with its row first."""
    found = []
    words, lengths, owner = words_of(part)
    ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
    for items, index in groups:
        # Only texts with a shingle of some item are looked at closer.
        h, _ = shingles(words, lengths, items.shingle)
        hits = np.flatnonzero(items.maybe[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        hits = hits[np.isin(h[hits], items.known)]
        for r in np.unique(owner[hits]).tolist():
            own = slice(ends[r], ends[r + 1])
            found += [(r, *x) for x in matches(items, index, words[own], lengths[own], radius, least)]
    return found


def prepared(benchmark: DataFrame, item: str, item_text: str, shingle: int) -> DataFrame:
    """The items that have words, with all that is looked for: ``item``, ``n``
    (shingle length), ``size``, ``bits``, ``hashes``, ``weights`` and ``bytes``."""
    kind = benchmark.schema[item].dataType.simpleString()
    names = ["item", "n", "size", "bits", "hashes", "weights"]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                if rows := list(item_rows(part, shingle)):
                    at, n, size, bits, hashes, weights = zip(*rows)
                    columns = (n, size, np.array(bits, np.uint64).view(np.int64), [h.view(np.int64) for h in hashes], weights)
                    yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(at)), *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    listed = benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    rows = listed.mapInArrow(run, f"item {kind}, n int, size int, bits long, hashes array<long>, weights array<long>")
    return rows.withColumn("bytes", 16 * F.size("hashes") + 64)


def item_blocks(benchmark: DataFrame, item: str, item_text: str, shingle: int, item_bytes: int):
    """The items, prepared by tasks, in broadcast blocks of about ``item_bytes``
    each, as many as the benchmark's size asks for, one after the other: their
    number, then each block."""
    spark = benchmark.sparkSession
    items = cut(prepared(benchmark, item, item_text, shingle), "items")
    size = items.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    yield blocks
    for block in range(blocks):
        # A block is of bounded size: its table is what is broadcast.
        mine = items.where(F.pmod(F.xxhash64("item", "hashes"), F.lit(blocks)) == block).orderBy("item", "hashes")
        yield spark.sparkContext.broadcast(make_items(mine.toArrow()))


def find(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, least: float = SIMILARITY, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Per row of ``df`` and item found in it: ``key``, ``item``,
    ``start_word``, ``n_words``, ``hamming``, ``similarity`` of the best window.

    Of an item's windows the most similar one counts, of equals the first. Items
    without words and null texts match nothing; a document shorter than an item
    is one window. Items that repeat are found as often, and so are repeated
    documents; null keys and null items are like any others. A very long text is
    scanned whole, 4,096 windows at a time. Other columns are not read, so none
    can clash. An empty table on either side finds nothing. A benchmark of
    several blocks is looked for block by block, each pass written before the
    next, so that an executor holds one block at a time.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = f"key {df.schema[key].dataType.simpleString()}, item {benchmark.schema[item].dataType.simpleString()}, start_word int, n_words int, hamming int, similarity double"
    out, sources = None, item_blocks(benchmark, item, item_text, shingle, item_bytes)
    blocks = next(sources)
    for shared in sources:

        def run(batches, shared=shared):
            groups = [(items, items.index(radius)) for items in shared.value]
            for batch in batches:
                for part in slices(batch, "text"):
                    if found := scan(part, groups, radius, least):
                        row, *columns = zip(*found)
                        types = (None, pa.int32(), pa.int32(), pa.int32(), pa.float64())
                        yield pa.RecordBatch.from_arrays(
                            [part.column("key").take(pa.array(row)), *(pa.array(x, t) for x, t in zip(columns, types))],
                            ["key", "item", "start_word", "n_words", "hamming", "similarity"],
                        )

        some = rows.mapInArrow(run, kind)
        if blocks > 1:
            some = cut(some, "found")
            shared.unpersist()
        out = some if out is None else out.unionByName(some)
    return out.withColumnsRenamed({"key": key, "item": item})


def keep_clean(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, least: float = SIMILARITY, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of ``df``, all columns, in which no item is found. Null texts
    hold none and stay; repeated rows and odd values fare as in ``find``. A
    benchmark of several blocks takes as many passes, each written."""
    sources = item_blocks(benchmark, item, item_text, shingle, item_bytes)
    blocks = next(sources)
    for shared in sources:

        def start(shared=shared):
            groups = [(items, items.index(radius)) for items in shared.value]

            def decide(part):
                clean = np.ones(part.num_rows, bool)
                clean[[x[0] for x in scan(part, groups, radius, least)]] = False
                return clean

            return decide

        df = filter_texts(df, text, start)
        if blocks > 1:
            df = cut(df, "clean")
            shared.unpersist()
    return df
