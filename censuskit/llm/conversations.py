"""Conversation structure repair by Hirschberg's divide and conquer.

The role initials of a conversation must read ``(s?(ua)+)?``: four states, of
which nothing read, and an assistant's turn read, may end it. Every row is an
element: for each pair of states the cheapest edits that lead from one to the
other over it. Costs forward from the start and backward from the end meet in
the middle; of the crossings with the least sum the one with the ASCII-least
edits before it is taken, and both halves are solved likewise, so that space
grows with the rows alone. Edits before two different crossings end with a row
each and differ, so their order decides: it travels forward as a rank beside
each cost.

Rows are sorted over the whole table into ranges of conversations. A conversation
within a range is solved where it lies. One that crosses ranges, or is very
long, is cut into pieces; a piece's elements multiply into one element, and the
same divide and conquer gives each part of a conversation, then each piece, the
states at its ends. No task holds a conversation's rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, shuffle_partitions

SPACE = " \t\n\x0b\x0c\r"
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: A row's first fault.
SOUND, CUT_OFF, BLANK, DUPLICATE = range(4)
#: What may follow each state (0 nothing read, 1 system, 2 user, 3 assistant),
#: and what brings each state to an end.
NEXT = ("user", "user", "assistant", "user")
AFTER = {"user": 2, "assistant": 3}
LAST = ("", "II", "I", "")
FINISH = tuple(INSERT * len(x) for x in LAST)
#: Rows and characters of a piece.
PIECE_ROWS, PIECE_CHARS = 4_096, 4 << 20
#: Conversations of up to ``SHORT`` rows whose edits a worker remembers by their
#: initials, repeats and faults.
SHORT, KNOWN = 16, 65_536
_KNOWN: dict[tuple, list[str]] = {}

Element = tuple[tuple[tuple[int, object] | None, ...], ...]


def keeps(state: int, initial: str) -> int | None:
    """The state after a row of this initial is kept."""
    if initial == "s":
        return 1 if state == 0 else None
    return {"user": 2 if initial == "u" else None, "assistant": 3 if initial == "a" else None}[NEXT[state]]


def _element(initial: str, fault: int) -> Element:
    """Of one row: cost and edits from each state to each, inserts first."""
    out: list[list] = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state = start
        for inserts in range(3):  # more come back to the same states
            ways = [(state, DELETE, "D")]
            if fault < BLANK:
                extra = TRUNCATED if fault == CUT_OFF else 0
                ways += [(keeps(state, initial), extra, "K"), (AFTER[NEXT[state]], REROLE + extra, "R")]
            for end, cost, letter in ways:
                if end is not None:
                    way = (INSERT * inserts + cost, "I" * inserts + letter)
                    out[start][end] = min(out[start][end] or way, way)
            state = AFTER[NEXT[state]]
    return tuple(map(tuple, out))


ELEMENTS = {(initial, fault): _element(initial, fault) for initial in ("s", "u", "a", "") for fault in range(4)}


def forward(vector: list, by: Element) -> list:
    """(cost, rank) of each state after an element; ranks order the edits."""
    new: list = [None] * 4
    for p, have in enumerate(vector):
        if have is not None:
            for q, way in enumerate(by[p]):
                if way is not None:
                    found = (have[0] + way[0], have[1], way[1])
                    if new[q] is None or found < new[q]:
                        new[q] = found
    ranked = sorted((x[1], x[2], q) for q, x in enumerate(new) if x is not None)
    rank = {q: n for n, (*_, q) in enumerate(ranked)}
    return [x and (x[0], rank[q]) for q, x in enumerate(new)]


def backward(by: Element, costs: list) -> list:
    """Least cost from each state before an element to the end."""
    return [min((way[0] + costs[q] for q, way in enumerate(row) if way is not None and costs[q] is not None), default=None) for row in by]


def crossing(ahead: list, behind: list) -> int:
    """The state with the least sum; of several the one of the least edits."""
    return min((f[0] + b, f[1], q) for q, (f, b) in enumerate(zip(ahead, behind)) if f is not None and b is not None)[2]


def states(elements: list[Element], start: int, finish) -> list[int]:
    """The states between elements on the cheapest, ASCII-least way from
    ``start``; ``finish`` has the cost of ending in each state (None: not)."""
    out = [start] * (len(elements) + 1)

    def ahead(low: int, high: int) -> list:
        vector: list = [None] * 4
        vector[out[low]] = (0, 0)
        for i in range(low, high):
            vector = forward(vector, elements[i])
        return vector

    def between(low: int, high: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        costs = [0 if q == out[high] else None for q in range(4)]
        for i in range(high - 1, middle - 1, -1):
            costs = backward(elements[i], costs)
        out[middle] = crossing(ahead(low, middle), costs)
        between(low, middle)
        between(middle, high)

    if elements:
        out[-1] = crossing(ahead(0, len(elements)), list(finish))
        between(0, len(elements))
    return out


def product(elements: list[Element]) -> list[int]:
    """The one element that a run of elements comes to, as 32 numbers: cost and
    rank from each state to each, -1 where there is no way."""
    out = []
    for start in range(4):
        vector: list = [(0, 0) if q == start else None for q in range(4)]
        for by in elements:
            vector = forward(vector, by)
        out += [v for x in vector for v in (x or (-1, -1))]
    return out


def as_element(numbers: list[int]) -> Element:
    pairs = [None if numbers[i] < 0 else (numbers[i], numbers[i + 1]) for i in range(0, 32, 2)]
    return tuple(tuple(pairs[p : p + 4]) for p in range(0, 16, 4))


def row_element(role: str, n: int, fault: int) -> Element:
    """The element of a row that stands ``n`` times (repeats are deleted)."""
    by = ELEMENTS[role[:1] if role[:1] in ("s", "u", "a") else "", fault]
    if n > 1:
        by = tuple(tuple(way and (way[0] + DELETE * (n - 1), way[1]) for way in row) for row in by)
    return by


def edits_between(by: Element, n: int, start: int, end: int) -> str:
    return "D" * (n - 1) + by[start][end][1]


def edits_of(rows: list[tuple], start: int = 0, finish: tuple = FINISH) -> list[str]:
    """Edits of each of the rows ``(turn, role, text, n, fault)``; with
    ``FINISH`` they make a whole conversation, whose last row has the inserts
    that end it."""
    key = tuple((r[1][:1], r[3], r[4]) for r in rows)
    if len(rows) > SHORT or finish != FINISH:
        return _edits(key, start, finish)
    if key not in _KNOWN:
        if len(_KNOWN) >= KNOWN:
            _KNOWN.clear()
        _KNOWN[key] = _edits(key, start, finish)
    return _KNOWN[key]


def _edits(key: tuple, start: int, finish) -> list[str]:
    elements = [row_element(*x) for x in key]
    at = states(elements, start, finish)
    edits = [edits_between(by, x[1], p, q) for by, x, p, q in zip(elements, key, at, at[1:])]
    if finish == FINISH and edits:
        edits[-1] += LAST[at[-1]]
    return edits


def repaired(state: int, role: str, text: str | None, edits: str) -> tuple[int, list[tuple[str, str]]]:
    """The state after a row's edits, and the rows that they make of it."""
    out = []
    for letter in edits:
        if letter == "K":
            state = keeps(state, role[:1])
            out.append((role, text))
        elif letter != "D":
            out.append((NEXT[state], "" if letter == "I" else text))
            state = AFTER[NEXT[state]]
    return state, out


class Report:
    """What is said of a conversation, gathered row by row."""

    def __init__(self) -> None:
        self.low = self.high = self.before = None
        self.distinct = self.illegal = self.cost = self.state = 0
        self.faults = [0] * 4
        self.audit: list[str] = []
        self.hash, self.joint = hashlib.sha256(), ""

    def add(self, turn, role: str, text: str | None, n: int, fault: int, edits: str) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.distinct += turn != self.high
            self.high = turn
        initial = role[:1]
        self.illegal += n - 1 + (self.before is not None and self.before + initial not in ("su", "ua", "au"))
        self.before = initial
        self.faults[fault] += n
        self.audit.append(edits)
        for letter in edits:
            self.cost += {"K": 0, "I": INSERT, "R": REROLE, "D": DELETE}[letter] + (TRUNCATED if fault == CUT_OFF and letter in "KR" else 0)
        self.state, made = repaired(self.state, role, text, edits)
        for line in made:
            self.hash.update(f"{self.joint}{line[0]}:{line[1]}".encode())
            self.joint = "\n"

    def done(self) -> dict:
        return {
            "gaps": 0 if self.low is None else self.high - self.low + 1 - self.distinct,
            "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT_OFF],
            "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
        }


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ARROW_REPORT = pa.struct([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in REPORT.split(", "))])
_ROW = ["turn", "role", "text", "n", "fault"]


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by ``crc32("conv:turn") % 20``, nulls in it, in roles and in
    texts written as one space: 0, the row is dropped; 1, its text is emptied; 2,
    loses its ``.``, ``!`` and ``?``; 3, the row stands twice; 4, it is a user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank(conv), blank(turn)).cast("binary")) % 20
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind")).where("kind != 0")
    texts = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), texts.alias("text"), "kind")
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.expr("if(kind = 3, array(0, 1), array(0))"))).drop("col")


def labelled(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, n, fault`` and their ``digest`` and ``again``:
    every content of a conversation once, where it stands first, and its repeats
    counted by turn, without their text."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    first = F.when(~F.max(F.col("turn").isNull()), F.min("turn")).alias("first")  # null comes first
    bare = F.rtrim("text", F.lit(SPACE))
    digest = F.unhex(F.sha2("text", 256))
    contents = rows.groupBy("conv", "role", "text").agg(first)
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(CUT_OFF)
    contents = contents.select("conv", F.col("first").alias("turn"), "role", "text", F.lit(1).cast("long").alias("n"), fault.cast("int").alias("fault"), digest.alias("digest"), F.lit(False).alias("again"))
    keys = rows.select("conv", "turn", "role", digest.alias("digest"), (bare == "").alias("blank"))
    keys = cut(keys.groupBy("conv", "turn", "role", "digest", "blank").agg(F.count("*").alias("n")), "turns")
    firsts = keys.groupBy("conv", "role", "digest").agg(first)
    firsts = firsts.select(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    repeats = keys.join(firsts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")))
    repeats = repeats.withColumn("n", F.col("n") - F.when(F.col("turn").eqNullSafe(F.col("first")), 1).otherwise(0)).where("n > 0")
    fault = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    repeats = repeats.select("conv", "turn", "role", F.lit(None).cast("string").alias("text"), "n", fault.cast("int").alias("fault"), "digest", F.lit(True).alias("again"))
    return contents.unionByName(repeats)


class _Table:
    """Records on their way out, as record batches of bounded size."""

    def __init__(self, kinds: dict[str, pa.DataType]):
        self.kinds, self.chars = kinds, 0
        self.columns: dict[str, list] = {n: [] for n in kinds}

    def add(self, **record) -> None:
        for name, values in self.columns.items():
            values.append(record.get(name))
        self.chars += 64 + len(record.get("text") or "")

    def full(self) -> bool:
        return self.chars > PIECE_CHARS

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(v, self.kinds[n]) for n, v in self.columns.items()], list(self.kinds))
        self.columns, self.chars = {n: [] for n in self.kinds}, 0
        return batch


def _kinds(conv: pa.DataType, turn: pa.DataType) -> dict[str, pa.DataType]:
    return {
        "conv": conv, "part": pa.int32(), "run": pa.int32(), "piece": pa.int32(), "seq": pa.int64(), "turn": turn, "role": pa.string(), "text": pa.string(), "n": pa.int64(),
        "fault": pa.int32(), "edits": pa.string(), "start": pa.int32(), "summary": pa.list_(pa.int64()), "report": _ARROW_REPORT,
    }


def _sql(conv: str, turn: str) -> str:
    return (
        f"conv {conv}, part int, run int, piece int, seq long, turn {turn}, role string, text string, n long, fault int, edits string, start int, "
        f"summary array<long>, report struct<{', '.join(x.replace(' ', ':') for x in REPORT.split(', '))}>"
    )


def _listed(batches, names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _whole(out: _Table, where: dict, rows: list[tuple], digest_only: bool) -> None:
    """A conversation that lies within one range, solved."""
    edits, state, report = edits_of(rows), 0, Report()
    for seq, (row, letters) in enumerate(zip(rows, edits)):
        if digest_only:
            report.add(*row, letters)
        else:
            out.add(**where, seq=seq, **dict(zip(_ROW, row)), edits=letters, start=state)
            state, _ = repaired(state, row[1], row[2], letters)
    if digest_only:
        out.add(**where, report=report.done())


def _solve_ranges(batches, digest_only: bool) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted range. Conversations that begin and end within it are
    solved; pieces of others come out as open rows with the piece's element."""
    part, out = TaskContext.get().partitionId(), None
    conv, run, piece, rows, chars, begun = None, -1, 0, [], 0, 0

    def close(whole: bool) -> None:
        nonlocal piece, rows, chars, begun
        where = {"conv": conv, "part": part, "run": run, "piece": piece}
        if whole:
            _whole(out, where, rows, digest_only)
        else:
            for seq, row in enumerate(rows):
                out.add(**where, seq=begun + seq, **dict(zip(_ROW, row)))
            out.add(**where, summary=product([row_element(*(r[1], r[3], r[4])) for r in rows]))
        piece, begun, rows, chars = piece + 1, begun + len(rows), [], 0

    for batch in batches:
        if out is None:
            out = _Table(_kinds(batch.schema.field("conv").type, batch.schema.field("turn").type))
        for own, *row in _listed([batch], ["conv", *_ROW]):
            if run < 0 or own != conv:
                if rows:
                    close(run > 0 and piece == 0)  # the first of a range may have begun before it
                conv, run, piece, begun = own, run + 1, 0, 0
            elif len(rows) >= PIECE_ROWS or chars > PIECE_CHARS:
                close(False)
            rows.append(tuple(row))
            chars += len(row[2] or "")
            if out.full():
                yield out.take()
    if rows:
        close(False)  # the last may go on in the next range
    if out is not None:
        yield out.take()


def _grouped(keys: list[str], run: Callable[[dict[str, list], Callable], dict], schema: pa.Schema):
    """For ``applyInArrow``: ``run`` gets a group's columns as lists."""

    def apply(table: pa.Table) -> pa.Table:
        table = table.sort_by([(k, "ascending") for k in keys])
        return pa.table(run({n: table.column(n).to_pylist() for n in table.column_names}, table), schema=schema)

    return apply


def _ends(summaries: DataFrame, conv: str) -> DataFrame:
    """``part, run, piece, start, end, tail`` of every open piece: first the
    parts of a conversation, then the pieces of a part, by the same divide and
    conquer. A group is the pieces within one range, or the ranges of one
    conversation: numbers only."""

    def multiply(c, table):
        return {"conv": table.column("conv").slice(0, 1), "part": c["part"][:1], "run": c["run"][:1], "summary": [product([as_element(x) for x in c["summary"]])]}

    def over_parts(c, table):
        at = states([as_element(x) for x in c["summary"]], 0, FINISH)
        return {"part": c["part"], "run": c["run"], "first": at[:-1], "last": at[1:], "rest": [""] * (len(at) - 2) + [LAST[at[-1]]]}

    def over_pieces(c, table):
        at = states([as_element(x) for x in c["summary"]], c["first"][0], [0 if q == c["last"][0] else None for q in range(4)])
        return {"part": c["part"], "run": c["run"], "piece": c["piece"], "begin": at[:-1], "end": at[1:], "tail": [""] * (len(at) - 2) + c["rest"][:1]}

    i32, text = pa.int32(), pa.string()

    def products(table: pa.Table) -> pa.Table:
        schema = pa.schema([("conv", table.schema.field("conv").type), ("part", i32), ("run", i32), ("summary", pa.list_(pa.int64()))])
        return _grouped(["piece"], multiply, schema)(table)

    by_part = summaries.groupBy("part", "run").applyInArrow(products, f"conv {conv}, part int, run int, summary array<long>")
    schema = pa.schema([("part", i32), ("run", i32), ("first", i32), ("last", i32), ("rest", text)])
    parts = by_part.groupBy("conv").applyInArrow(_grouped(["part"], over_parts, schema), "part int, run int, first int, last int, rest string")
    schema = pa.schema([("part", i32), ("run", i32), ("piece", i32), ("begin", i32), ("end", i32), ("tail", text)])
    pieces = summaries.drop("conv").join(parts, ["part", "run"]).groupBy("part", "run")
    return pieces.applyInArrow(_grouped(["piece"], over_pieces, schema), "part int, run int, piece int, begin int, end int, tail string")


def _solve_pieces(batches) -> Iterator[pa.RecordBatch]:
    """Open rows sorted by piece, with the states at the piece's ends: solved."""
    names = ["conv", "part", "run", "piece", "seq", *_ROW, "begin", "end", "tail"]
    key, held, out = None, [], None

    def close() -> None:
        rows = [r[5:10] for r in held]
        begin, end, tail = held[0][10:]
        edits = edits_of(rows, begin, tuple(0 if q == end else None for q in range(4)))
        edits[-1] += tail
        state = begin
        for r, letters in zip(held, edits):
            out.add(**dict(zip(names[:10], r)), edits=letters, start=state)
            state, _ = repaired(state, r[6], r[7], letters)

    for batch in batches:
        if out is None:
            out = _Table(_kinds(batch.schema.field("conv").type, batch.schema.field("turn").type))
        for row in _listed([batch], names):
            if row[1:4] != key:
                if held:
                    close()
                key, held = row[1:4], []
                if out.full():
                    yield out.take()
            held.append(row)
    if held:
        close()
    if out is not None:
        yield out.take()


def _solved(df: DataFrame, conv: str, turn: str, role: str, text: str, digest_only: bool) -> tuple[DataFrame, DataFrame]:
    """Records of whole conversations (rows, or reports), and rows of open ones."""
    n = shuffle_partitions(df.sparkSession)
    order = ["conv", "turn", "role", "digest", "again"]
    ranged = labelled(df, conv, turn, role, text).repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv", *_ROW)
    kinds = (df.schema[conv].dataType.simpleString(), df.schema[turn].dataType.simpleString())
    records = cut(ranged.mapInArrow(lambda batches: _solve_ranges(batches, digest_only), _sql(*kinds)), "conversations")
    ends = _ends(records.where("summary is not null").select("conv", "part", "run", "piece", "summary"), kinds[0])
    open_rows = records.where("seq is not null and edits is null").select("conv", "part", "run", "piece", "seq", *_ROW)
    order = ["part", "run", "piece", "seq"]
    rows = open_rows.join(ends, order[:3]).repartition(n, *order[:3]).sortWithinPartitions(*order)
    return records.where("edits is not null or report is not null"), rows.mapInArrow(_solve_pieces, _sql(*kinds))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of ``df`` with their edits: ``conv`` and ``turn``, ``part`` and
    ``seq`` (their order within a conversation), ``role``, ``text``, ``n`` (times
    that the row stands there), ``fault`` (sound, truncated, blank, duplicate),
    ``edits`` (letters) and ``repaired`` (what becomes of it: an array of
    ``role`` and ``text``, in order). A row's edits may begin with inserts and
    delete its repeats; the last row's may end with inserts.

    Rows are taken by turn (null first), then role, then a digest of the text.
    Null roles and texts count as one space. Blank rows and rows whose role and
    text stood earlier are deleted; repeats come as one row a turn, without
    their text. Repeated turns are in order; conversations of any length and
    texts of any length are cut into pieces of rows. A null key is a
    conversation. Other columns are not read. No rows, none back.
    """
    whole, rest = _solved(df, conv, turn, role, text, False)
    names = F.array(*[F.lit(x) for x in ("sound", "truncated", "blank", "duplicate")])

    def made(batches):
        for batch in batches:
            out = [[{"role": r, "text": t} for r, t in repaired(*row)[1]] for row in _listed([batch], ["start", "role", "text", "edits"])]
            yield batch.append_column("repaired", pa.array(out, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))))

    rows = whole.unionByName(rest).select("conv", "turn", "part", "seq", "role", "text", "n", F.get(names, F.col("fault")).alias("fault"), "edits", "start")
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(made, f"{kinds}, repaired array<struct<role:string,text:string>>").drop("start").withColumnsRenamed({"conv": conv, "turn": turn})


def _reports(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation: a report each."""
    conv, report, out = None, None, None

    def kinds(batch):
        return {"conv": batch.schema.field("conv").type, "report": _ARROW_REPORT}

    for batch in batches:
        out = out or _Table(kinds(batch))
        for own, *row in _listed([batch], ["conv", *_ROW, "edits"]):
            if report is None or own != conv:
                if report:
                    out.add(conv=conv, report=report.done())
                conv, report = own, Report()
            report.add(*row)
    if report:
        out.add(conv=conv, report=report.done())
        yield out.take()


def report(df: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation (each ``conv`` of ``ids``, by default of ``df``): ``gaps``
    in its turns, rows ``blank``, ``duplicate`` and ``truncated`` (first faults),
    ``illegal`` neighbours, ``cost`` and ``audit`` of the cheapest, ASCII-least
    edits, and ``repaired_sha256`` of the repaired ``role:text`` lines. Rows and
    odd values as in ``repair``; a conversation without rows has zeros, no edits
    and the digest of nothing.

    SHA-256 reads a conversation front to back: those that cross ranges are
    streamed through one hash each, row by row; all else is done in pieces."""
    whole, rest = _solved(df, conv, turn, role, text, True)
    kind = df.schema[conv].dataType.simpleString()
    streamed = rest.repartition(shuffle_partitions(df.sparkSession), "conv").sortWithinPartitions("conv", "part", "seq").select("conv", *_ROW, "edits")
    said = whole.select("conv", "report").unionByName(streamed.mapInArrow(_reports, f"conv {kind}, report struct<{', '.join(x.replace(' ', ':') for x in REPORT.split(', '))}>"))
    every = (df if ids is None else ids).select(F.col(conv).alias("_conv")).distinct()
    joined = every.join(said, F.col("_conv").eqNullSafe(F.col("conv")), "left")
    empty = Report().done()
    fill: list[Column] = [F.coalesce(F.col(f"report.{n}"), F.lit(v)).cast("string" if isinstance(v, str) else "long").alias(n) for n, v in empty.items()]
    return joined.select(F.col("_conv").alias(conv), *fill)


# --- the same in SQL, row by row ---------------------------------------------


def _report_sql() -> str:
    """DuckDB SQL of ``report(damaged(conversations))``: four best (cost, audit,
    text) a conversation, carried from row to row; turns must be distinct."""

    def best(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def way(state: str, cost: str, letter: str, line: str | None = None) -> str:
        text = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"

    def insert(state: str, role: str) -> str:
        return way(state, str(INSERT), "I", f"'{role}:'")

    def closed(states: str) -> str:  # with inserts, which cost most once and twice
        once = f"SELECT *, {best('s2', insert('s0', 'user'), insert('s1', 'user'), insert('s3', 'user'))} AS p2 FROM ({states}) x"
        return f"SELECT *, s0 AS p0, s1 AS p1, {best('s3', insert('p2', 'assistant'))} AS p3 FROM ({once}) y"

    never = 1 << 40
    stays = f"CASE WHEN fault IN ('blank', 'duplicate') THEN {never} WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END"
    keep = lambda s, initial: way(s, f"(CASE WHEN left(role, 1) = '{initial}' THEN {stays} ELSE {never} END)", "K", "role || ':' || text")
    rerole = lambda s, role: way(s, f"{REROLE} + {stays}", "R", f"'{role}:' || text")
    delete = lambda s: way(s, str(DELETE), "D")
    step = f"""SELECT conv_id, i + 1 AS i, {delete('p0')} AS s0, {best(delete('p1'), keep('p0', 's'))} AS s1,
      {best(delete('p2'), *(f(s, x) for s in ('p0', 'p1', 'p3') for f, x in ((rerole, 'user'), (keep, 'u'))))} AS s2,
      {best(delete('p3'), rerole('p2', 'assistant'), keep('p2', 'a'))} AS s3"""
    far = f"{{'c': CAST({never} AS BIGINT), 'a': '', 't': ''}}"
    solid = r"[^\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE bits AS (
  SELECT range AS n, range AS v, 0 AS k FROM range(256)
  UNION ALL SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
byte AS (SELECT n, v FROM bits WHERE k = 8),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
crc AS (
  SELECT DISTINCT key, 1 AS i, CAST(4294967295 AS BIGINT) AS v FROM source
  UNION ALL SELECT key, i + 1, xor(crc.v >> 8, byte.v) FROM crc JOIN byte ON byte.n = xor(crc.v & 255, ord(substr(key, i, 1))) WHERE i <= length(key)),
kinds AS (SELECT key, xor(v, 4294967295) % 20 AS kind FROM crc WHERE i = length(key) + 1),
rows AS (
  SELECT conv_id, turn, again, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM source JOIN kinds USING (key), range(2) r(again) WHERE kind <> 0 AND (again = 0 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, again) AS i FROM rows),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{solid}') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'sound' END AS fault,
         coalesce(left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
walk AS (
  SELECT DISTINCT conv_id, CAST(1 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3 FROM faults
  UNION ALL {step} FROM ({closed("SELECT walk.*, role, text, fault FROM walk JOIN faults ON walk.conv_id IS NOT DISTINCT FROM faults.conv_id AND walk.i = faults.i")}) z),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faults GROUP BY conv_id),
ends AS (
  SELECT conv_id, {best('p0', 'p3')} AS e FROM ({closed("SELECT walk.* FROM walk JOIN counted ON walk.conv_id IS NOT DISTINCT FROM counted.conv_id AND walk.i = counted.n + 1")}) z)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN counted ON q.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN ends ON q.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


REPORT_SQL = _report_sql()
