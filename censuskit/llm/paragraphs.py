"""Substring deduplication by paragraphs.

Paragraphs (texts between line feeds) are shingled and min-hashed. Equal
paragraphs are one class from the start, so copies, however many, never meet as
pairs. The signatures of the classes are cut into bands, tuned for recall;
classes that share a band's value meet in one task, where exact Jaccard
similarity verifies them, and come out as links contracted there, not as pairs.
A band value that very many classes share is dealt out in chunks of bounded
size, and only what its chunks leave unconnected is compared across them. Each
component keeps its first paragraph.

A passage may lie within longer paragraphs, or be wrapped into lines at other
places. So every run of ``PASSAGE`` words, line feeds or not, that stands earlier
is a repeat, too. To find all of them without comparing all, anchors of ``ANCHOR``
words are picked by their hashes so that each run of ``PASSAGE`` words holds one,
the same wherever it stands; only around anchors that recur are all runs hashed.
Each different text is looked at once; its copies are known by the words of the
whole text. What repeats is removed in stretches: words that repeated paragraphs or
runs cover without a gap, ``STRETCH`` and more. A lone stock line stays.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components, contract
from .decontam import shingles
from .shared import cut, raw_bytes, shuffle_partitions, slices
from .words import LOWER, SOLID, mix, prefix_sums, runs, spans, sums

SHINGLE = 5
SIMILARITY = 0.8
#: Repeated words in a row that make a passage. Fewer are left alone.
STRETCH = 30
#: Words of a run that is a repeat wherever it stands earlier, and of the anchors
#: by which such runs are found.
PASSAGE, ANCHOR = 50, 18
#: Wanted chance that a pair at the least similarity shares a band, and min-hashes
#: that may be spent on it.
RECALL = 0.9999
HASHES = 40
#: Classes that meet in one task as one chunk.
CHUNK = 2_000
#: Colliding classes, and texts with anchors that recur (8 bytes each), up to which
#: they are broadcast to pick out shingles and texts; beyond it both sides are shuffled.
BROADCAST_CLASSES = 1_000_000


def tune(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands that reach the recall within ``hashes``."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(2, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= hashes:
            best = (bands, rows)
    return best


def anchors(values: np.ndarray, bounds: np.ndarray, passage: int) -> np.ndarray:
    """First words of the anchors: in every run of ``passage`` words of a row
    (row ``r`` has words ``bounds[r]`` to ``bounds[r + 1]``) the ``ANCHOR`` words
    of the least hash, the first of equals. ``values`` are hashes of the words
    from each place on."""
    width = passage - ANCHOR + 1  # places of an anchor in a run
    last = np.repeat(bounds[1:], np.diff(bounds)) - passage
    least = (values >> np.uint64(28) << np.uint64(28)) | np.arange(len(values), dtype=np.uint64)
    done = 1
    while done < width:
        step = min(done, width - done)
        least, done = np.minimum(least[: max(0, len(least) - step)], least[step:]), done + step
    at = np.arange(len(least))
    found = (least & np.uint64((1 << 28) - 1))[at <= last[: len(least)]].astype(np.int64)
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def units_of(part: pa.RecordBatch, shingle: int, passage: int) -> tuple[np.ndarray, ...]:
    """Of a slice of texts: row, first word (from the text's start), words and
    class of each paragraph of ``shingle`` words and more, of each text of
    ``passage`` and more, and of each anchor; whether it is an anchor; the shingles
    of the paragraphs with their bounds."""
    words, bounds, feeds, starts, rows = _words(part)
    line = np.searchsorted(feeds, starts)  # line feeds before a word
    edge = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (rows[1:] != rows[:-1])])) if len(starts) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(edge, len(starts)))
    first, size = edge[sizes >= shingle], sizes[sizes >= shingle]
    h, _ = shingles(words, np.zeros(len(words), np.int64), shingle)
    count = size - shingle + 1
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    own = h[at] if len(at) else np.zeros(0, np.uint64)
    long = np.flatnonzero(np.diff(bounds) >= passage)
    total = sums(words)
    runs_ = spans(total, np.arange(len(words)), np.minimum(np.arange(len(words)) + ANCHOR, len(words)))
    found = anchors(runs_, bounds, passage)
    cls = [
        mix(spans(total, first, first + size) + size.astype(np.uint64)),
        mix(~spans(total, bounds[long], bounds[long + 1]) + np.diff(bounds)[long].astype(np.uint64)),
        mix(~runs_[found] + np.uint64(ANCHOR)),
    ]
    first = np.concatenate([first, bounds[long], found]).astype(np.int64)
    size = np.concatenate([size, np.diff(bounds)[long], np.full(len(found), ANCHOR)]).astype(np.int64)
    row = rows[first] if len(first) else np.zeros(0, np.int64)
    anchor = np.arange(len(first)) >= len(first) - len(found)
    return row, (first - bounds[row]), size, np.concatenate(cls).view(np.int64), anchor, own, np.concatenate([[0], np.cumsum(count)]).astype(np.int64)


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of a slice of texts, A-Z in lower case: hashes of the words, each row's
    first word and the end, line feeds, starts and rows of the words."""
    data, offsets = raw_bytes(part.column("text"))
    data = LOWER[data]
    starts, ends, rows = runs(data, offsets, SOLID)
    bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
    return spans(prefix_sums(data), starts, ends), bounds, np.flatnonzero(data == 10), starts, rows


def signatures(own: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band values (a row of longs a paragraph) of lists of shingles."""
    out = np.zeros((len(bounds) - 1, bands), np.uint64)
    for band in range(bands):
        for row in range(rows):
            seed = mix(np.array([band * rows + row + 1], np.uint64))
            out[:, band] = mix(out[:, band] + np.minimum.reduceat(mix(own ^ seed), bounds[:-1]))
        out[:, band] = mix(out[:, band] + np.uint64(band))  # a value tells its band
    return out.view(np.int64)


def listed(df: DataFrame, shingle: int, bands: int, rows: int, passage: int = PASSAGE) -> DataFrame:
    """``doc``, ``mark`` (of its text), ``start``, ``words`` and ``cls`` of every
    paragraph, long text and ``anchor``, and whether its class stood ``again`` in
    its text; ``bands`` and ``shingles`` (32 bits each) once for each class of paragraphs
    and task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                row, start, size, cls, anchor, own, bounds = units_of(part, shingle, passage)
                if not len(row):
                    continue
                count = np.diff(bounds)
                new = np.array([c not in seen and not seen.add(c) for c in cls[: len(count)].tolist()], bool)
                some = np.concatenate([[0], np.cumsum(count[new])]).astype(np.int64)
                kept = own[np.repeat(new, count)]
                sig = signatures(kept, some, bands, rows) if new.any() else np.zeros((0, bands), np.int64)
                new, count = (np.concatenate([x, np.zeros(len(row) - len(x), x.dtype)]) for x in (new, count))
                order = np.lexsort((start, cls, row))
                again = np.zeros(len(row), bool)
                again[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (cls[order[1:]] == cls[order[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(row)), part.column("mark").take(pa.array(row)), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(cls), pa.array(anchor), pa.array(again),
                        _lists(sig.ravel(), np.where(new, bands, 0), new), _lists(kept.astype(np.uint32).view(np.int32), np.where(new, count, 0), new),
                    ],
                    ["doc", "mark", "start", "words", "cls", "anchor", "again", "bands", "shingles"],
                )

    kind = df.schema["doc"].dataType.simpleString()
    return df.mapInArrow(run, f"doc {kind}, mark long, start int, words int, cls long, anchor boolean, again boolean, bands array<long>, shingles array<int>")


def _lists(values: np.ndarray, sizes: np.ndarray, valid: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(~valid))


def verified(members: list[tuple[int, int, frozenset]], least: float) -> list[tuple[int, int]]:
    """Links between classes of similarity ``least`` that connect all such
    pairs; ``members`` are (side, class, shingles). With two sides only pairs
    across them count. A class is compared with a cluster until one of its
    members is near: the rest of the cluster is connected already."""
    links: list[tuple[int, int]] = []
    cross = len({side for side, _, _ in members}) > 1
    clusters: list[list[tuple[int, int, frozenset]]] = []
    for own in sorted(members):
        side, cls, shingles = own
        joined = None
        for n, cluster in enumerate(clusters):
            for other_side, other, theirs in cluster:
                if cross and other_side == side:
                    continue
                small, big = sorted((len(shingles), len(theirs)))
                if small < least * big:
                    continue
                both = len(shingles & theirs)
                if both >= least * (small + big - both):
                    links.append((cls, other))
                    if joined is None:
                        joined = n
                    else:
                        clusters[joined] += cluster
                        clusters[n] = []
                    break
        if joined is None:
            clusters.append([own])
        else:
            clusters[joined].append(own)
        clusters = [c for c in clusters if c]
    return links


def _verify(batches, least: float):
    """Rows sorted by block: the links within each block."""
    names = ["value", "low", "high"]
    key, members, node, root = None, [], [], []

    def flush():
        for a, b in verified(members, least):
            node.append(a)
            root.append(b)

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        sets = batch.column("shingles")
        for n, (here, side, cls) in enumerate(zip(zip(*columns), batch.column("side").to_pylist(), batch.column("cls").to_pylist())):
            if here != key:
                flush()
                key, members = here, []
            members.append((side, cls, frozenset(sets[n].values.to_numpy().tolist())))
        if len(node) > 100_000:
            yield _contracted(node, root)
            node, root = [], []
    flush()
    if node:
        yield _contracted(node, root)


def _contracted(node, root):
    a, b = contract(np.array(node, np.int64), np.array(root, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["node", "root"])


def similar(classes: DataFrame, least: float = SIMILARITY, chunk: int = CHUNK, broadcast_classes: int = BROADCAST_CLASSES) -> DataFrame:
    """Links ``(node, root)`` that connect all classes (``cls``, ``bands``,
    ``shingles``; rows that repeat a class do no harm) that share a band value
    and are similar.

    A value of more than ``chunk`` classes is dealt out in chunks, in another way
    for each value. What links within chunks connect needs no more comparing: of
    such a value only classes outside its largest component are compared with
    all others, chunk by chunk."""
    n, block = shuffle_partitions(classes.sparkSession), ["value", "low", "high"]
    # Read twice below, by plans that are alike down to the exchange, so shuffled once.
    keyed = classes.select("cls", F.explode("bands").alias("value")).where("value is not null and cls is not null").repartition(n, "value")
    shared = keyed.groupBy("value").agg(F.min("cls").alias("a"), F.max("cls").alias("b"), F.count("*").alias("n")).where("a != b")
    met = cut(keyed.join(shared.select("value", F.ceil(F.col("n") / chunk).alias("chunks")), "value").distinct().select("cls", "value", "chunks"), "collisions")
    wanted = met.select("cls").distinct()
    wanted = F.broadcast(wanted) if wanted.count() <= broadcast_classes else wanted.hint("merge")
    sets = classes.select("cls", "shingles").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))

    def links(rows: DataFrame) -> DataFrame:
        full = rows.join(sets, "cls").repartition(n, *block).sortWithinPartitions(*block)
        return full.mapInArrow(lambda batches: _verify(batches, least), "node long, root long")

    own = F.pmod(F.xxhash64("cls", "value"), F.col("chunks"))
    within = links(met.select("cls", "value", own.alias("low"), own.alias("high"), F.lit(0).alias("side")))
    dealt = met.where("chunks > 1")
    if not dealt.limit(1).count():
        return within
    within = cut(within, "links-within")
    dealt = cut(dealt.join(components(within), F.col("cls") == F.col("node"), "left").select("cls", "value", "chunks", F.coalesce("root", "cls").alias("root")), "dealt")
    sizes = dealt.groupBy("value", "root").agg(F.count("*").alias("n")).groupBy("value").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"))
    strays = sizes.where("n > most.n").select("value", F.col("most.root").alias("largest"), F.ceil((F.col("n") - F.col("most.n")) / chunk).alias("parts"))
    open_ = dealt.join(strays, "value")
    part, last = F.pmod(F.xxhash64("cls", "value"), F.col("parts")), lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    few = open_.where("root != largest").select("cls", "value", part.alias("low"), last("chunks").alias("high"), F.lit(0).alias("side"))
    all_ = open_.select("cls", "value", last("parts").alias("low"), own.alias("high"), F.lit(1).alias("side"))
    return within.unionByName(links(few.unionByName(all_)))


def _stretches(batches, least: int):
    """Rows ``(doc, mark, found)`` of sorted repeats: the stretches they cover."""
    for batch in batches:
        out = []
        for found in batch.column("found"):
            start, size = (found.values.field(i).to_numpy() for i in (0, 1))
            end = np.maximum.accumulate(start + size)
            first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
            begin, words = start[first], np.append(end[first[1:] - 1], end[-1]) - start[first]
            out.append([{"start": b, "words": n} for b, n in zip(begin.tolist(), words.tolist()) if n >= least])
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())])))], ["doc", "mark", "removed"])


def _around(batches, passage: int):
    """Rows ``(doc, mark, text, starts)``: the runs of ``passage`` words that hold
    an anchor of ``starts``."""
    for batch in batches:
        done = 0
        for texts in slices(batch.select(["text"]), "text"):
            part, done = batch.slice(done, texts.num_rows), done + texts.num_rows
            words, bounds, *_ = _words(texts)
            held = part.column("starts")
            at = held.values.to_numpy()[held.offsets[0].as_py() : held.offsets[-1].as_py()].astype(np.int64)
            row = np.repeat(np.arange(part.num_rows), np.diff(held.offsets.to_numpy()))
            low = np.maximum(at - (passage - ANCHOR), 0) + bounds[row]
            high = np.minimum(at + bounds[row], bounds[row + 1] - passage)
            edge = np.bincount(low, minlength=len(words) + 1) - np.bincount(high + 1, minlength=len(words) + 1)
            first = np.flatnonzero(np.cumsum(edge) > 0)
            row = np.searchsorted(bounds, first, side="right") - 1
            cls = spans(sums(words), first, first + passage).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc").take(pa.array(row)), part.column("mark").take(pa.array(row)), pa.array((first - bounds[row]).astype(np.int32)), pa.array(cls)],
                ["doc", "mark", "start", "cls"],
            )


def repeated_runs(texts: DataFrame, units: DataFrame, passage: int, broadcast_texts: int = BROADCAST_CLASSES) -> DataFrame:
    """``doc``, ``mark``, ``start`` and ``words`` of all runs of ``passage`` words
    that stand earlier, in the first document of each text."""
    found = units.where("anchor")
    recur = found.groupBy("cls").agg(F.min("mark").alias("a"), F.max("mark").alias("b"), F.max("again").alias("c")).where("a != b or c").select("cls")
    recur = cut(recur, "recurring")  # read back, so that an anchor in very many texts can be split in the join
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc")).alias("first")
    near = found.join(recur.hint("merge"), "cls").groupBy("mark").agg(first, F.collect_set("start").alias("starts"))
    near = cut(near.select(F.col("first.doc").alias("_doc"), F.col("mark").alias("_mark"), "starts"), "anchors")
    held = F.col("mark") == F.col("_mark")
    some = near.select("_mark")
    if some.count() <= broadcast_texts:
        texts = texts.join(F.broadcast(some), held, "left_semi")
    own = texts.join(near.hint("merge"), held & F.col("doc").eqNullSafe(F.col("_doc"))).select("doc", "mark", "text", "starts")
    kind = texts.schema["doc"].dataType.simpleString()
    every = own.mapInArrow(lambda batches: _around(batches, passage), f"doc {kind}, mark long, start int, cls long")
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark", "start")
    # The first place of a class, which repeated rows may name more than once, stays.
    keep = F.first(place).over(Window.partitionBy("cls").orderBy(F.col("doc").isNull(), "doc", "mark", "start"))
    return every.withColumn("keep", keep).where(place != F.col("keep")).select("doc", "mark", "start", F.lit(passage).alias("words"))


def marked_texts(texts: DataFrame, shingle: int, least: float, stretch: int, recall: float, chunk: int, passage: int) -> DataFrame:
    """Per ``doc`` and ``mark`` with something repeated: ``removed``, stretches
    of words (an array of ``start`` and ``words``)."""
    if passage < ANCHOR:
        raise ValueError(f"passage: {ANCHOR} words and more")
    bands, rows = tune(least, recall)
    texts = texts.withColumn("text", F.coalesce("text", F.lit("")))
    every = cut(listed(texts, shingle, bands, rows, passage), "paragraphs")
    units = every.where("not anchor")
    roots = components(similar(units.where("bands is not null").select("cls", "bands", "shingles"), least, chunk))
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark", "start")
    firsts = units.where("not again").groupBy("cls").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    own = firsts.join(linked, F.col("cls") == F.col("node"), "left").where("root is not null or n > 1").select("cls", F.coalesce("root", "cls").alias("root"), "first")
    own = cut(own, "repeated")
    kept = own.join(own.groupBy("root").agg(F.min("first").alias("keep")), "root").select("cls", "keep").hint("merge")
    span = ["doc", "mark", "start", "words"]
    repeats = units.where("not again").select(*span, "cls").join(kept, "cls").where(place != F.col("keep")).select(*span).unionByName(units.where("again").select(*span))
    repeats = repeats.unionByName(repeated_runs(texts, every, passage))
    found = repeats.groupBy("doc", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "words"))).alias("found"))  # of one text
    kind = texts.schema["doc"].dataType.simpleString()
    return found.mapInArrow(lambda batches: _stretches(batches, stretch), f"doc {kind}, mark long, removed array<struct<start:int,words:int>>")


def _with_marks(df: DataFrame, key: str, text: str, options: dict, text_too: bool) -> DataFrame:
    options = {"shingle": SHINGLE, "least": SIMILARITY, "stretch": STRETCH, "recall": RECALL, "chunk": CHUNK, "passage": PASSAGE} | options
    texts = df.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"))
    by_doc = marked_texts(texts, **options).withColumnsRenamed({"doc": "_doc", "mark": "_mark"})
    rows = texts if text_too else texts.drop("text")
    found = rows.join(by_doc, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left")
    none = F.array().cast("array<struct<start:int,words:int>>")
    return found.select("doc", *["text"] * text_too, F.coalesce("removed", none).alias("removed"))


def _without(batches):
    """Rows ``(doc, text, removed)`` with the text that is left: a stretch goes
    up to the next word that stays. Null texts stay null."""
    for batch in batches:
        done = 0
        for texts in slices(pa.RecordBatch.from_arrays([pa.compute.fill_null(batch.column("text"), "")], ["text"]), "text"):
            part, done = batch.slice(done, texts.num_rows), done + texts.num_rows
            data, offsets = raw_bytes(texts.column("text"))
            starts, _, rows = runs(data, offsets, SOLID)
            bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
            kept = []
            for i, (known, removed) in enumerate(zip(part.column("text").is_valid().to_pylist(), part.column("removed").to_pylist())):
                words, place, pieces = np.append(starts[bounds[i] : bounds[i + 1]], offsets[i + 1]), offsets[i], []
                for r in removed:
                    pieces.append(data[place : words[r["start"]]].tobytes())
                    place = words[r["start"] + r["words"]]
                kept.append(b"".join([*pieces, data[place : offsets[i + 1]].tobytes()]).decode() if known else None)
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("removed"), pa.array(kept, pa.string())], ["doc", "removed", "kept_text"])


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``df``: key, ``removed`` (the stretches of words that go, an
    array of ``start``, counted from 0, and ``words``) and ``kept_text``. Options:
    ``shingle``, ``least`` similarity, ``stretch`` (its least words), ``recall``,
    ``chunk``, ``passage`` (words of a run).

    Of paragraphs that links of similarity ``least`` connect, and of equal runs of
    ``passage`` words, the one of the smallest key stays (then of the smallest hash of the text, then the first);
    the others are repeats, and go where they cover ``stretch`` words in a row.
    Paragraphs of fewer than ``shingle`` words have no shingle and count only as
    parts of runs. Null and empty texts have no words and stay as they are; a
    null key comes after all others. Repeated rows are the same document and
    fare alike; rows of one key with different texts are documents of their own,
    told apart by 64 bits. Very long texts are handled whole, one at a time. Other
    columns of ``df`` are not read, so none can clash. No rows, none back.
    """
    marked = _with_marks(df, key, text, options, True)
    kind = marked.schema["doc"].dataType.simpleString()
    kept = marked.mapInArrow(_without, f"doc {kind}, removed array<struct<start:int,words:int>>, kept_text string")
    return kept.withColumnRenamed("doc", key)


def report(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``deduplicate`` without the texts, which then needn't be shuffled: key,
    ``n_removed`` (words), ``n_spans`` and ``removed``."""
    marked = _with_marks(df, key, text, options, False)
    words = F.aggregate("removed", F.lit(0), lambda n, x: n + x["words"])
    return marked.select(F.col("doc").alias(key), words.alias("n_removed"), F.size("removed").alias("n_spans"), "removed")
