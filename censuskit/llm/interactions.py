"""Audit of how filters interact, by decision diagrams.

Every document has a failure mask: one bit a filter. Documents are counted by
part and mask on DataFrames, so a part, however large, is at most ``2**filters``
rows. Each part's counts become a decision diagram: a level a filter, two
children a node (documents that pass, documents that fail), counts at the
leaves and on every node. Equal sub-diagrams are one node. All orders of the
filters are visited by exchanging two neighbouring levels at a time, which
touches the nodes of these levels only; the path on which everything passes
gives what each step of that order keeps and removes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: Words are longest runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Filters beyond this have too many orders to list them all.
MOST_FILTERS = 7


class Node:
    """A sub-diagram: the counts of its documents, and those that pass and fail
    its level's filter (leaves have neither)."""

    __slots__ = ("passes", "fails", "counts")

    def __init__(self, passes: Node | None, fails: Node | None, counts: tuple[int, ...]):
        self.passes, self.fails, self.counts = passes, fails, counts


def _joined(level: dict[tuple[int, int], Node], passes: Node, fails: Node) -> Node:
    """The one node of a level that has these children."""
    key = (id(passes), id(fails))
    if key not in level:
        level[key] = Node(passes, fails, tuple(map(add, passes.counts, fails.counts)))
    return level[key]


class Diagram:
    """Decision diagram of ``filters`` filters over counts by failure mask (bit
    ``i``: filter ``i`` fails; masks that are absent count zero)."""

    def __init__(self, filters: int, counts: dict[int, tuple[int, ...]], width: int):
        self.order = list(range(filters))
        leaves: dict[tuple[int, ...], Node] = {}
        zero = (0,) * width
        row = [leaves.setdefault(c, Node(None, None, c)) for c in (counts.get(self._mask(i, filters), zero) for i in range(1 << filters))]
        self.levels: list[list[Node]] = []
        for _ in range(filters):
            level: dict[tuple[int, int], Node] = {}
            row = [_joined(level, a, b) for a, b in zip(row[::2], row[1::2])]
            self.levels.insert(0, list(level.values()))
        self.root = row[0]

    @staticmethod
    def _mask(path: int, filters: int) -> int:
        """The mask of a leaf: the root's filter is the path's highest bit."""
        return sum(1 << i for i in range(filters) if path >> (filters - 1 - i) & 1)

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next. Nodes above keep
        their children, nodes of ``level`` their counts."""
        below: dict[tuple[int, int], Node] = {}
        for node in self.levels[level]:
            a, b = node.passes, node.fails
            node.passes, node.fails = _joined(below, a.passes, b.passes), _joined(below, a.fails, b.fails)
        self.levels[level + 1] = list(below.values())
        self.order[level : level + 2] = self.order[level : level + 2][::-1]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Filter, counts kept and counts removed, step by step: the path on
        which every filter passes."""
        node = self.root
        for f in self.order:
            yield f, node.passes.counts, node.fails.counts
            node = node.passes


def plain_changes(n: int) -> Iterator[int]:
    """Neighbouring places to exchange so that all orders of ``n`` things come
    up, each once."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1)
        if (at := next(inner, None)) is None:
            return
        yield at + 1
        yield from range(n - 1)
        if (at := next(inner, None)) is None:
            return
        yield at


def orders(filters: int, counts: dict[int, tuple[int, ...]], width: int) -> dict[str, np.ndarray]:
    """Of one part, for every order and step: ``order`` (filter numbers, a row
    an order), ``filter``, ``kept`` and ``removed`` (a column a count)."""
    diagram = Diagram(filters, counts, width)
    listed, steps = [], []

    def read():
        listed.append(tuple(diagram.order))
        steps.append([(f, *kept, *removed) for f, kept, removed in diagram.steps()])

    read()
    for level in plain_changes(filters):
        diagram.swap(level)
        read()
    table = np.array(steps, np.int64).reshape(len(listed), filters, 1 + 2 * width)
    return {"order": np.array(listed).reshape(len(listed), filters), "filter": table[:, :, 0], "kept": table[:, :, 1 : 1 + width], "removed": table[:, :, 1 + width :]}


def masks(df: DataFrame, part: Column, fails: dict[str, Column], marks: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """``part``, ``mask`` (bit ``i``: the ``i``-th of ``fails`` holds),
    ``documents`` and a column for each of ``marks``: the documents for which it
    holds. ``weight`` is what a row counts (one). Null conditions do not hold."""
    bit = lambda c: F.when(c, 1).otherwise(0)
    mask = sum((bit(c) * (1 << i) for i, c in enumerate(fails.values())), F.lit(0)).cast("int")
    weight = F.lit(1) if weight is None else weight
    rows = df.select(part.alias("part"), mask.alias("mask"), weight.cast("long").alias("documents"), *[(bit(c) * weight).cast("long").alias(n) for n, c in marks.items()])
    return rows.groupBy("part", "mask").agg(*[F.sum(n).alias(n) for n in ("documents", *marks)])


def audit(counted: DataFrame, letters: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """Every order of the filters on every part of ``masks``' rows: ``part``,
    ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant`` (failing the
    step's filter, removed earlier), ``unique_fails`` (failing this filter
    only), ``<mark>_lost`` (removed here, for each mark) and ``shapley`` (the
    filter's removed, summed over all orders). No parts, no rows; a null part is
    a part of its own. ``letters`` name the filters, one character each."""
    filters, names, width = len(letters), [*marks], 1 + len(marks)
    if not 1 <= filters <= MOST_FILTERS or any(len(x) != 1 for x in letters):
        raise ValueError(f"1 to {MOST_FILTERS} filters of one letter each")
    # At most 2**filters entries a part.
    grouped = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "documents", *names)).alias("masks"))
    rows_a_part = math.factorial(filters) * filters

    def run(batches):
        for batch in batches:
            for part, entries in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist()):
                t = orders(filters, {e["mask"]: (e["documents"], *[e[n] for n in names]) for e in entries}, width)
                flat = t["filter"].ravel()
                removed = t["removed"].reshape(-1, width)
                # All that fail a filter go where it is first; those that fail it alone go where it is last.
                failing, alone, shapley = (np.zeros(filters, np.int64) for _ in range(3))
                failing[t["filter"][:, 0]] = t["removed"][:, 0, 0]
                alone[t["filter"][:, -1]] = t["removed"][:, -1, 0]
                np.add.at(shapley, flat, removed[:, 0])
                text = np.repeat(["".join(letters[f] for f in order) for order in t["order"]], filters)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * rows_a_part, pa.string()), pa.array(text, pa.string()), pa.array(np.tile(np.arange(1, filters + 1, dtype=np.int32), len(t["order"]))),
                        *map(pa.array, (t["kept"][:, :, 0].ravel(), removed[:, 0], failing[flat] - removed[:, 0], alone[flat], *removed.T[1:], shapley[flat])),
                    ],
                    columns,
                )

    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[f"{n}_lost" for n in names], "shapley"]
    return grouped.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in columns[3:]))


def first_of_each_text(df: DataFrame) -> DataFrame:
    """``df`` (``doc``, ``digest`` and more) with ``repeated``: whether a smaller
    ``doc`` has the same digest; a null ``doc`` comes after all others. Rows
    are matched by digest and ``doc`` together, so that a text of very many
    documents is not one task's."""
    firsts = df.groupBy("digest").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc")).alias("first"))
    firsts = firsts.select(F.col("digest").alias("_digest"), F.col("first.doc").alias("_doc"), F.lit(False).alias("_repeated"))
    found = df.join(firsts, (F.col("digest") == F.col("_digest")) & F.col("doc").eqNullSafe(F.col("_doc")), "left")
    return found.select(*df.columns, F.coalesce("_repeated", F.lit(True)).alias("repeated"))


def document_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Five filters on whole texts, audited by ``part`` in all 120 orders with
    ``audit``: A, under 50 words; B, under 65 % of the words distinct; C, more
    than 5 % of the characters are A to Z; D, one of ``#$%&*|``; E, a text that
    a smaller key has, too, anywhere in the table.

    A null text counts as empty, a null part as the empty string. A null key
    comes after all others and has no labels; rows that repeat a key count each,
    do not repeat one another, and share its labels; a key with several label
    rows is good, or toxic, if one of them says so. Texts are compared by 256-bit
    digests. Very long texts are read whole, in the JVM. An empty table has no
    parts and gives no rows; other columns of either table are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    rows = df_columns(docs, key=F.col(key), part=F.coalesce(F.col(part).cast("string"), F.lit("")), text=content)
    rows = rows.withColumn("n_words", F.size(words)).withColumn("n_distinct", F.size(F.array_distinct(words)))
    fails = {
        "A": F.col("n_words") < 50,
        "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
        "C": 100 * F.char_length(F.regexp_replace("text", "[^A-Z]", "")) > 5 * F.char_length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }
    narrow = rows.select(F.col("key").alias("doc"), "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(n) for n, c in fails.items()])
    narrow = cut(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n")), "failures")
    said = df_columns(labels, key=F.col(key), good=F.col("quality") == 1, toxic=F.col("toxic") == 1).where("key is not null")
    said = said.groupBy(F.col("key").alias("_key")).agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    marked = first_of_each_text(narrow).join(said, F.col("doc") == F.col("_key"), "left")
    counted = masks(marked, F.col("part"), {n: F.col(n) for n in "ABCD"} | {"E": F.col("repeated")}, {"good": F.col("good"), "toxic": F.col("toxic")}, F.col("n"))
    return audit(counted, "ABCDE", ["good", "toxic"])


def df_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """The named columns and no other, so that none can clash."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS low FROM texts GROUP BY text),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
         FROM labels GROUP BY doc_id),
flags AS (
  SELECT t.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
          'C': 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 5 * length(t.text),
          'D': regexp_matches(t.text, '[#$%&*|]'), 'E': t.doc_id > f.low} AS fail
  FROM texts t JOIN firsts f ON t.text = f.text LEFT JOIN said l ON t.doc_id = l.doc_id),
masks AS (
  SELECT part, fail.A AS a, fail.B AS b, fail.C AS c, fail.D AS d, fail.E AS e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM flags GROUP BY ALL),
failing AS (
  SELECT part, n, good, toxic, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS f FROM masks),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT v.x || w.x || y.x || z.x || u.x AS filter_order
  FROM letters v, letters w, letters y, letters z, letters u
  WHERE len(list_distinct([v.x, w.x, y.x, z.x, u.x])) = 5),
steps AS (
  SELECT p.part, filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
  FROM (SELECT DISTINCT part FROM masks) p, orders, range(1, 6) r(step)),
met AS (
  SELECT s.part, filter_order, step, x, n, good, toxic, f, contains(f, x) AS fails, translate(f, before, '') <> f AS gone
  FROM steps s JOIN failing m ON s.part = m.part),
counted AS (
  SELECT part, filter_order, step, x,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN f = x THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted
"""
