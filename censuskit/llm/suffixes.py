"""Exact substring deduplication by a logarithmic family of sorted indexes.

A window is ``length`` bytes of a text. Every window has one anchor, the place
of its smallest hashed ``gram`` (the first of equals); equal windows have equal
anchors at equal distances, and neighbouring windows mostly share theirs. A
stretch of windows with one anchor is one entry: its key is the anchor's gram,
its content the fingerprint of all its bytes.

The levels are not suffix arrays: entries are sorted by 64-bit fingerprints of
sampled stretches, not by the bytes that follow, so there is no suffix order
and no common prefix. Only whether 100-byte windows are equal is asked, and the
bytes of the sampled suffixes alone would be 6.3 times the input on their way
(see the README).

Keys are dealt out by hash; a part takes its rows in document order, batch by
batch. A batch is sorted, merge-scanned against the levels of the index for
earlier equal entries, and becomes a level itself; levels of equal size merge. A
stretch found whole is a repeat in all its windows. Where one gram has different
stretches, they are told apart on longer ones, as suffix sorting doubles its
prefixes: every window holds the longer stretch to the left or the one to the
right of its anchor, so the windows of each side are looked up by that stretch
first, and one by one only where it, too, has different surroundings.

Each task reduces what it reads: of a key it passes on one row, and what it can
decide by itself never travels. So no text, however often it is copied, makes a
hot key. Rows travel packed in columns, a block for each task and part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, raw_bytes, shuffle_partitions, slices
from .words import every, mix, prefix_sums, spans

LENGTH = 100
GRAM = 24
#: The longest ``length``: a stretch counts its windows in 16 bits.
LONGEST = 1 << 15
#: Entries of a batch that becomes one level, bytes of text at a time, rows that
#: leave a task at a time; bytes of text whose entries are one part, which a worker
#: holds whole (about as many bytes of entries).
BATCH = 1 << 16
SLICE = 1 << 20
ROWS = 1 << 17
PART_BYTES = 64 << 20

REPEAT, OPEN, SINGLE = 1, 2, 0
_PLACE = np.uint64(32)  # low bits of a ranked gram that hold its place


class LogIndex:
    """Sorted indexes as levels: columns sorted by the first, the key. Sizes at
    least halve from level to level; the columns may be changed in place."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []

    def scan(self, *wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge-scans the keys ``wanted[0]``, with further columns that must be
        equal, too, against each level: the level and place of each, -1 if none
        has it. Few entries may share a key and differ in the other columns."""
        level, place = np.full(len(wanted[0]), -1), np.zeros(len(wanted[0]), np.int64)
        for n, columns in enumerate(self.levels):
            at = np.searchsorted(columns[0], wanted[0])
            for _ in range(len(columns[0])):
                ok = at < len(columns[0])
                ok[ok] = columns[0][at[ok]] == wanted[0][ok]
                same = ok.copy()
                for own, other in zip(columns[1:], wanted[1:]):
                    same[same] = own[at[same]] == other[same]
                level[same], place[same] = n, at[same]
                if not (ok & ~same).any():
                    break
                at = at + (ok & ~same)
        return level, place

    def add(self, *columns: np.ndarray) -> None:
        if not len(columns[0]):
            return
        self.levels.append(list(columns))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            b, a = self.levels.pop(), self.levels.pop()
            both = [np.concatenate(x) for x in zip(a, b)]
            order = np.argsort(both[0], kind="stable")  # two runs: a merge
            self.levels.append([x[order] for x in both])


def joint(key: np.ndarray, content: np.ndarray) -> np.ndarray:
    """One key for both; entries are compared in both, still."""
    return mix(key.view(np.uint64) + mix(content.view(np.uint64))).view(np.int64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def stretches(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray, length: int, gram: int):
    """The sampled stretches of texts end to end: row, first window, number of
    windows, anchor gram, fingerprint (of all bytes and the anchor's place)."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = every(sums, gram)
    # The smallest gram of each window, the leftmost of equals.
    ranked = (grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(ranked, length - gram + 1) & np.uint64((1 << 32) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    starts = np.flatnonzero(np.arange(length, length + n) <= offsets[row + 1])
    row, anchor = row[starts], anchor[starts]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])) if len(starts) else starts
    first, at = starts[new], anchor[new]
    count = np.diff(np.append(new, len(starts)))
    content = spans(sums, first, first + count + length - 1)
    content = mix(content + mix(((at - first) << 32).astype(np.uint64) + count.astype(np.uint64)))
    return row[new], first, count, grams[at], content


#: A row on its way: a key, its content, where its windows begin, how many they
#: are, what is known of them, and whether it is to be looked up.
_ROW = [("key", "<i8"), ("content", "<i8"), ("doc", "<i8"), ("mark", "<i8"), ("start", "<i4"), ("count", "<i2"), ("state", "<i1"), ("sent", "<i1")]
_WIDTH = sum(np.dtype(t).itemsize for _, t in _ROW)
_BLOCK = "part int, rows binary"
_FOUND = "doc long, mark long, start int, count int, state byte"
_FOUND_TYPES = [("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("state", pa.int8())]


def _emit(columns):
    """Found rows, some at a time."""
    for low in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[low : low + ROWS], t) for c, (_, t) in zip(columns, _FOUND_TYPES)], [n for n, _ in _FOUND_TYPES])


def _pack(parts: int, *columns: np.ndarray):
    """The rows that have something to tell, dealt to parts: those to be looked
    up by key, the others anywhere. In a block they stand in document order."""
    key, _, doc, mark, start, _, state, sent = columns
    part = np.where(sent, key.view(np.uint64), mix(doc.view(np.uint64) ^ start.astype(np.uint64))) % np.uint64(parts)
    order = np.lexsort((start, mark, doc, part))
    order = order[sent[order] | (state[order] != SINGLE)]
    part = part[order].astype(np.int32)
    columns = [c[order] for c in columns]
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
    for low, high in zip(edges[:-1], edges[1:]):
        for at in range(low, high, ROWS):
            block = slice(at, min(at + ROWS, high))
            raw = b"".join(c[block].astype(t).tobytes() for c, (_, t) in zip(columns, _ROW))
            yield pa.RecordBatch.from_arrays([pa.array(part[at : at + 1]), pa.array([raw], pa.binary())], ["part", "rows"])


def _unpack(batches):
    """The rows of each part, in document order; blocks come sorted by part."""
    here, held = None, []

    def whole():
        columns = [np.concatenate(x) for x in zip(*held)]
        order = np.lexsort((columns[4], columns[3], columns[2]))
        return [c[order] for c in columns]

    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("rows")):
            if part != here and held:
                yield whole()
                held = []
            here, raw, at, columns = part, raw.as_buffer(), 0, []
            n = len(raw) // _WIDTH
            for _, t in _ROW:
                columns.append(np.frombuffer(raw, t, n, at))
                at += n * np.dtype(t).itemsize
            held.append(columns)
    if held:
        yield whole()


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _one_of_each(held: list[tuple], keys: int) -> list[np.ndarray]:
    """The held columns sorted by their first ``keys`` and then by place (doc,
    mark, start, which follow), a place of repeated rows once."""
    columns = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    order = np.lexsort(tuple(reversed(columns[: keys + 3])))
    columns = [c[order] for c in columns]
    same = np.logical_and.reduce([c[1:] == c[:-1] for c in columns[: keys + 3]])
    keep = np.concatenate([[True], ~same])
    return [c[keep] for c in columns]


def _reduced(held: list[tuple], parts: int):
    """A task's rows (key, content, doc, mark, start, count): repeats of others
    here, those whose key has other contents here (open), and of each key the
    first in document order, sent to be looked up elsewhere."""
    if not held:
        return
    key, content, doc, mark, start, count = _one_of_each(held, 2)
    first = np.concatenate([[True], key[1:] != key[:-1]])
    new = first | np.concatenate([[True], content[1:] != content[:-1]])
    group = np.cumsum(first) - 1
    several = np.bincount(group, weights=new)[group] > 1
    state = np.where(~new, REPEAT, np.where(several, OPEN, SINGLE)).astype(np.int8)
    by_place = np.lexsort((start, mark, doc, group))
    sent = np.zeros(len(key), bool)
    sent[by_place[np.concatenate([[True], group[by_place][1:] != group[by_place][:-1]])]] = True
    yield from _pack(parts, key, content, doc, mark, start, count, state, sent)


def _suffixes(batches, length: int, gram: int, parts: int):
    """A task's sampled stretches."""
    held: list[tuple] = []
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            data, offsets = raw_bytes(part.column("text"))
            row, first, count, key, content = stretches(data, offsets, prefix_sums(data), length, gram)
            if len(row):
                doc, mark = (x[row] for x in _columns(part, "doc", "mark"))
                held.append((key.view(np.int64), content.view(np.int64), doc, mark, (first - offsets[row]).astype(np.int32), count.astype(np.int16)))
    yield from _reduced(held, parts)


def _look_up(columns):
    """Found rows of a part. Its rows, in document order, are one a task and
    key: a content met before is a repeat; of a key with different contents the
    first of each is open."""
    keys, contents = LogIndex(), LogIndex()  # an entry for each key; for each key and content

    def batch_of(key, content, doc, mark, start, count, state):
        order = np.lexsort((np.arange(len(key)), content, key))
        key, content, doc, mark, start, count, state = (x[order] for x in (key, content, doc, mark, start, count, state))
        first = np.concatenate([[True], key[1:] != key[:-1]])
        new = first | np.concatenate([[True], content[1:] != content[:-1]])
        group, lead = np.cumsum(first) - 1, np.flatnonzero(first)  # by key
        own, head = np.cumsum(new) - 1, np.flatnonzero(new)  # by key and content; the first of each
        level, place = keys.scan(key[lead])
        known_open = np.zeros(len(lead), bool)
        for n, columns_ in enumerate(keys.levels):
            here = level == n
            known_open[here] = columns_[5][place[here]] == OPEN
        both = joint(key[head], content[head])
        same_level, same_place = contents.scan(both, key[head], content[head])
        fresh = same_level < 0
        different = np.bincount(group[head], weights=fresh) + (level >= 0)
        open_ = known_open | (different > 1) | (np.bincount(group, weights=state == OPEN) > 0)
        out = []
        for n, columns_ in enumerate(keys.levels):  # an entry that was alone and no longer is
            at = place[(level == n) & open_ & ~known_open]
            columns_[5][at] = OPEN
            out.append([*(columns_[c][at] for c in (1, 2, 3, 4)), np.full(len(at), OPEN, np.int8)])
        # The places of the first of each content, here or in the index: others repeat it.
        leading = [x[head].copy() for x in (doc, mark, start)]
        for n, columns_ in enumerate(contents.levels):
            here = same_level == n
            for x, c in zip(leading, (3, 4, 5)):
                x[here] = columns_[c][same_place[here]]
        repeat = np.logical_or.reduce([x != y[own] for x, y in zip((doc, mark, start), leading)])
        out.append([doc[repeat], mark[repeat], start[repeat], count[repeat], np.full(int(repeat.sum()), REPEAT, np.int8)])
        opened = head[fresh & open_[group[head]]]
        out.append([*(x[opened] for x in (doc, mark, start, count)), np.full(len(opened), OPEN, np.int8)])
        fresh = np.flatnonzero(fresh)[np.argsort(both[fresh], kind="stable")]
        contents.add(both[fresh], *(x[head[fresh]] for x in (key, content, doc, mark, start)))
        lead, now = lead[level < 0], np.where(open_, OPEN, SINGLE).astype(np.int8)[level < 0]
        keys.add(*(x[lead] for x in (key, doc, mark, start, count)), now)
        return [np.concatenate(x) for x in zip(*out)]

    sent = columns[7] != 0
    told = (columns[6] != SINGLE) & ~sent
    yield from _emit([c[told] for c in columns[2:7]])
    columns = [c[sent] for c in columns[:7]]
    for low in range(0, len(columns[0]), BATCH):
        yield from _emit(batch_of(*(c[low : low + BATCH] for c in columns)))


def _open(part: pa.RecordBatch):
    """Per open stretch of a slice: row, first window, windows."""
    lists = part.column("open")
    start, count = (lists.flatten().field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("start", "count"))
    return np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy())), start, count


def _halves(batches, length: int, gram: int, parts: int):
    """The windows of open suffixes in two runs, left and right: all windows of
    a run hold the longer stretch on that side of their anchor, its key; all its
    bytes are its content."""
    held: list[tuple] = []
    side = (length - gram) // 2
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            data, offsets = raw_bytes(part.column("text"))
            sums = prefix_sums(data)
            row, start, count = _open(part)
            begin = start + offsets[row]
            grams = every(sums, gram)
            # The anchor: the smallest gram of the first window.
            spread = begin[:, None] + np.arange(length - gram + 1)[None]
            anchor = begin + np.argmin(grams[spread] >> _PLACE, axis=1) if len(begin) else begin
            doc, mark = (x[row] for x in _columns(part, "doc", "mark"))
            # Windows that begin at least ``side`` before the anchor, and the rest.
            cut_ = np.clip(anchor - side - begin + 1, 0, count)
            for low, n, a, b in ((start, cut_, anchor - side, anchor + gram), (start + cut_, count - cut_, anchor, anchor + gram + length - gram - side)):
                use = n > 0
                key = spans(sums, a[use], b[use]).view(np.int64)
                key = mix(key.view(np.uint64) + (a[use] == anchor[use]).astype(np.uint64)).view(np.int64)
                from_, to = (low + offsets[row])[use], (low + offsets[row] + n + length - 1)[use]
                content = spans(sums, from_, to)
                content = mix(content + mix(((anchor[use] - from_ + length) << 32).astype(np.uint64) + n[use].astype(np.uint64))).view(np.int64)
                held.append((key, content, doc[use], mark[use], low[use].astype(np.int32), n[use].astype(np.int16)))
    yield from _reduced(held, parts)


def _windows(batches, length: int, gram: int, parts: int):
    """The windows of what is still open: of equal ones in a task the first is
    sent, the others are repeats. Windows are equal if their bytes' hash and
    that of their first gram are: the key holds both."""
    held: list[tuple] = []
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            data, offsets = raw_bytes(part.column("text"))
            sums = prefix_sums(data)
            row, start, count = _open(part)
            row = np.repeat(row, count)
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
            begin = at + offsets[row]
            key, content = spans(sums, begin, begin + length), spans(sums, begin, begin + gram)
            doc, mark = (x[row] for x in _columns(part, "doc", "mark"))
            held.append((key.view(np.int64), content.view(np.int64), doc, mark, at.astype(np.int32), np.ones(len(at), np.int16)))
    if not held:
        return
    key, content, *rest = _one_of_each(held, 2)
    sent = np.concatenate([[True], (key[1:] != key[:-1]) | (content[1:] != content[:-1])])[: len(key)]
    yield from _pack(parts, key, content, *rest, np.where(sent, SINGLE, REPEAT).astype(np.int8), sent)


def _look_up_windows(columns):
    """Repeats among the windows of a part, one a task and window, in document
    order."""
    index = LogIndex()

    def batch_of(key, content, doc, mark, start, count):
        both = joint(key, content)
        order = np.lexsort((np.arange(len(key)), content, key, both))
        both, key, content, doc, mark, start, count = (x[order] for x in (both, key, content, doc, mark, start, count))
        lead = np.concatenate([[True], (key[1:] != key[:-1]) | (content[1:] != content[:-1])])
        level, _ = index.scan(both[lead], key[lead], content[lead])
        fresh = np.flatnonzero(lead)[level < 0]
        repeat = np.ones(len(key), bool)
        repeat[fresh] = False
        index.add(both[fresh], key[fresh], content[fresh])
        return [*(x[repeat] for x in (doc, mark, start, count)), np.full(int(repeat.sum()), REPEAT, np.int8)]

    sent = columns[7] != 0
    yield from _emit([c[~sent] for c in columns[2:7]])
    columns = [c[sent] for c in columns[:6]]
    for low in range(0, len(columns[0]), BATCH):
        yield from _emit(batch_of(*(c[low : low + BATCH] for c in columns)))


def _looked_up(blocks: DataFrame, parts: int, look_up) -> DataFrame:
    """Blocks brought together by part, and what a look-up finds there."""

    def run(batches):
        for columns in _unpack(batches):
            yield from look_up(columns)

    return blocks.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, _FOUND)


def _keep(batches, length: int):
    """Each text without the bytes that its spans cover."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            data, offsets = raw_bytes(part.column("text"))
            lists = part.column("spans")
            sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()), 0)
            flat = lists.flatten()
            start, count = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("start", "count"))
            row = np.repeat(np.arange(part.num_rows), sizes)
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, offsets[row] + start, 1)
            np.add.at(edge, offsets[row] + start + count + length - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
            # A run ends with its text, even if the next begins with one.
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            at = offsets[:-1][np.diff(offsets) > 0]
            begins[at] = gone[at]
            total, runs = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[offsets] for x in (gone, begins))
            kept, at = data[~gone].tobytes(), np.concatenate([[0], np.cumsum(~gone, dtype=np.int64)])[offsets]
            texts = [kept[a:b] for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("mark"), pa.array(np.diff(offsets)), pa.array(np.diff(total)), pa.array(np.diff(runs)), pa.array(texts, pa.binary())],
                ["doc", "mark", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def _kept(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Per ``doc`` and ``mark`` of ``texts``: ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept``."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(shuffle_partitions(texts.sparkSession), -(-size // PART_BYTES))
    # Rows alike are combined before they travel. Read three times below, shuffled once.
    one = texts.groupBy("doc", "mark").agg(F.first("text").alias("text"))
    blocks = texts.select("doc", "mark", "text").mapInArrow(lambda b: _suffixes(b, length, gram, n), _BLOCK)
    found = cut(_looked_up(blocks, n, _look_up), "stretches")

    def of_open(rows: DataFrame) -> DataFrame:
        lists = rows.where(F.col("state") == OPEN).groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "count")).alias("open"))  # of one text
        return one.join(lists, ["doc", "mark"]).select("doc", "mark", "text", "open")

    halves = _looked_up(of_open(found).mapInArrow(lambda b: _halves(b, length, gram, n), _BLOCK), n, _look_up)
    again = _looked_up(of_open(halves).mapInArrow(lambda b: _windows(b, length, gram, n), _BLOCK), n, _look_up_windows)
    spans_ = found.unionByName(halves).where(F.col("state") == REPEAT).unionByName(again).select("doc", "mark", "start", "count")
    covered = spans_.groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "count")).alias("spans"))  # of one text
    whole = one.join(covered, ["doc", "mark"], "left").select("doc", "mark", "text", "spans")
    return whole.mapInArrow(lambda b: _keep(b, length), "doc long, mark long, n_bytes long, n_removed long, n_spans long, kept binary")


def _by_row(df: DataFrame, key: str, text: str, length: int, gram: int, digest: bool) -> DataFrame:
    if not gram <= length <= LONGEST:
        raise ValueError(f"length must be from gram ({gram}) to {LONGEST}")
    content = F.coalesce(F.col(text), F.lit(""))
    texts = df.select(F.col(key).alias("id"), F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(content).alias("mark"), content.cast("binary").alias("text"))
    out = _kept(texts.select("doc", "mark", "text"), length, gram)
    if digest:
        out = out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    rows = texts.select("id", "doc", "mark").join(out, ["doc", "mark"])
    return rows.select(F.col("id").alias(key), *[c for c in out.columns if c not in ("doc", "mark")])


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row of ``df``: key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs) and ``kept``, the bytes left of the UTF-8 text.

    A byte goes if a run of ``length`` bytes (``gram`` to 32,768) that covers it
    also starts earlier: in a document of smaller key (an integer), or further to
    the front of the same one. A null text is empty; a null key comes after all
    others. Rows of one key and text are one document and fare alike, worked out
    once; texts that differ under one key are told apart and ordered by a 64-bit
    hash. Equality rests on two 64-bit fingerprints. Texts under ``length`` bytes
    lose nothing; very long ones are handled whole, one at a time. Other columns
    are not read, so none can clash. No rows, none back.
    """
    return _by_row(df, key, text, length, gram, False)


def report(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``deduplicate`` with ``kept_sha256`` (lowercase hex) for the bytes."""
    return _by_row(df, key, text, length, gram, True)
