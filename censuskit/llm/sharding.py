"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on a ring of ``2**ring_bits`` cells; a row's
key falls on a cell and goes to the first point clockwise. A shard that is full
passes later rows on to the next shard clockwise. Rows count in ring order, so
the overflow can be worked out on counts alone: one row per arc, at most
``shards * vnodes`` rows whatever the input, folded by SQL higher-order
functions. Rows then find their shard and slot from their rank in their cell,
by a join with a table that has at most one row per cell and per overflow.
Everything is DataFrame or SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

VNODES = 64
RING_BITS = 16
#: Rows of a ring cell that are ranked in one sort; a cell with more is cut.
CELL_ROWS = 100_000

# ``arcs`` in ring order, each with its rows ``n`` and its shards ``clockwise``;
# ``caps`` is what each shard may hold. An arc's rows go to its shards in turn,
# each taking what it still has free.
_TAKE = """
aggregate(x.clockwise, named_struct('left', x.n, 'takes', cast(array() as array<struct<shard:int,n:bigint>>)),
  (t, s) -> if(t.left > 0 and acc.free[s] > 0,
    named_struct('left', t.left - least(t.left, acc.free[s]),
                 'takes', array_append(t.takes, named_struct('shard', s, 'n', least(t.left, acc.free[s])))),
    t)).takes
"""
_FOLD = f"""
aggregate(arcs,
  named_struct('free', caps, 'out', cast(array() as array<array<struct<shard:int,n:bigint>>>)),
  (acc, x) -> aggregate(array({_TAKE}),
    acc,
    (before, takes) -> named_struct(
      'free', transform(before.free, (f, s) -> aggregate(filter(takes, y -> y.shard = s), f, (left, y) -> left - y.n)),
      'out', array_append(before.out, takes)))).out
"""


def _cell(bits: int, *parts) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - bits)


def ring(spark, shards: int, vnodes: int = VNODES, ring_bits: int = RING_BITS) -> DataFrame:
    """The points: ``arc`` (0 up, in ring order), ``point`` (its cell), ``own``
    (its shard). At most ``shards * vnodes`` rows."""
    points = spark.range(shards).select(F.col("id").cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(vnodes - 1))).alias("v"))
    points = points.select("own", "v", _cell(ring_bits, F.lit("ring"), "own", "v").alias("point"))
    order = Window.orderBy("point", "own", "v")  # bounded: one row per virtual node
    return points.select((F.row_number().over(order) - 1).alias("arc"), "point", "own")


def _caps(total: F.Column, shards: int, slack: float | None) -> F.Column:
    s = F.sequence(F.lit(0), F.lit(shards - 1))
    if slack is None:
        return F.transform(s, lambda i: F.floor(total / shards) + F.when(i < total % shards, 1).otherwise(0)).cast("array<bigint>")
    return F.transform(s, lambda i: F.ceil(total * (1 + slack) / shards)).cast("array<bigint>")


def assign(
    df: DataFrame, shards: int, key: str = "doc_id", vnodes: int = VNODES, ring_bits: int = RING_BITS, slack: float | None = None
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0 up without
    gaps in each shard).

    ``slack`` bounds a shard's rows by ``(1 + slack)`` times the mean; ``None``
    is the tightest bound, counts at most one apart. A row's place on the ring
    comes from ``key`` alone; rows with one key (repeated rows, null keys) share
    a cell and fill shards clockwise like any others. An empty table stays
    empty. A cell of more than ``CELL_ROWS`` rows (one key on very many rows) is
    ranked in parts, for which the rows are numbered and written once. Columns
    ``shard`` and ``slot`` of ``df``, or ones that begin with ``_ring``, are an
    error.
    """
    if clash := [c for c in df.columns if c in ("shard", "slot") or c.startswith("_ring")]:
        raise ValueError(f"columns {clash} clash with those of the ring")
    spark = df.sparkSession
    cells = df.select(_cell(ring_bits, F.col(key)).alias("cell")).groupBy("cell").agg(F.count("*").alias("rows"))
    points = ring(spark, shards, vnodes, ring_bits)
    ends = points.groupBy("point").agg(F.min("arc").alias("arc"))
    # The arc of a cell: the first point at or after it, else the ring's first.
    marks = cells.select("cell", "rows", F.lit(None).cast("int").alias("arc")).unionByName(
        ends.select(F.col("point").alias("cell"), F.lit(None).cast("long").alias("rows"), "arc")
    )
    back = Window.orderBy(F.col("cell").desc(), F.col("arc").isNull()).rowsBetween(Window.unboundedPreceding, 0)  # bounded: cells and points
    placed = marks.select("cell", "rows", F.coalesce(F.last("arc", ignorenulls=True).over(back), F.lit(0)).alias("arc")).where("rows is not null")
    by_arc = placed.groupBy("arc").agg(F.sum("rows").alias("n"))
    listed = points.join(by_arc, "arc", "left").select("arc", "own", F.coalesce("n", F.lit(0)).alias("n"))
    whole = listed.agg(F.sort_array(F.collect_list(F.struct("arc", "own", "n"))).alias("ring"))
    # Each arc's shards in the order of their first points from its own on.
    arcs = whole.select("ring.own", F.explode("ring").alias("x")).select(
        F.struct(
            "x.arc", "x.n",
            F.array_distinct(F.concat(F.expr("slice(own, x.arc + 1, size(own))"), F.expr("slice(own, 1, x.arc)"))).alias("clockwise"),
        ).alias("x")
    )
    one = arcs.agg(F.sort_array(F.collect_list("x")).alias("arcs"), F.sum("x.n").alias("total")).withColumn("caps", _caps(F.col("total"), shards, slack))
    takes = one.select(F.posexplode(F.expr(_FOLD)).alias("arc", "takes")).select("arc", F.posexplode("takes").alias("turn", "take"))
    in_arc, in_shard = Window.partitionBy("arc").orderBy("turn"), Window.partitionBy("shard").orderBy("arc", "turn")
    chunks = (
        takes.select("arc", "turn", "take.shard", "take.n")
        .withColumn("hi", F.sum("n").over(in_arc))
        .withColumn("slot0", F.sum("n").over(in_shard) - F.col("n"))
        .select("arc", "shard", (F.col("hi") - F.col("n")).alias("lo"), "hi", "slot0")
    )
    first = Window.partitionBy("arc").orderBy("cell")
    bases = placed.withColumn("base", F.sum("rows").over(first) - F.col("rows"))
    # One row per cell and chunk that meet: at most cells + chunks rows.
    pieces = (
        bases.join(chunks, "arc")
        .where((F.col("lo") < F.col("base") + F.col("rows")) & (F.col("hi") > F.col("base")))
        .select(
            F.col("cell").alias("_cell"), "shard",
            (F.col("lo") - F.col("base")).alias("_lo"), (F.col("hi") - F.col("base")).alias("_hi"),
            (F.col("slot0") + F.col("base") - F.col("lo")).alias("_slot"),
        )
    )
    ranked = _ranked(df.withColumn("_ring_cell", _cell(ring_bits, F.col(key))), key, cells)
    found = ranked.join(F.broadcast(pieces), F.col("_ring_cell") == F.col("_cell")).where((F.col("_ring_rank") >= F.col("_lo")) & (F.col("_ring_rank") < F.col("_hi")))
    return found.select(*df.columns, "shard", (F.col("_slot") + F.col("_ring_rank")).alias("slot"))


def _ranked(rows: DataFrame, key: str, cells: DataFrame) -> DataFrame:
    """``rows`` with ``_ring_rank``, their place (from 0) in their cell."""
    order = [F.xxhash64(F.col(key)), F.col(key)]
    hot = cells.where(F.col("rows") > CELL_ROWS).select(F.col("cell").alias("_ring_hot"), F.ceil(F.col("rows") / CELL_ROWS).alias("_ring_parts"))
    if not hot.limit(1).count():
        return rows.withColumn("_ring_rank", F.row_number().over(Window.partitionBy("_ring_cell").orderBy(*order)) - 1)
    # One row per hot cell, and per part of it: at most rows / CELL_ROWS + cells.
    rows = cut(rows.withColumn("_ring_row", F.monotonically_increasing_id()), "ring-rows")
    rows = rows.join(F.broadcast(hot), F.col("_ring_cell") == F.col("_ring_hot"), "left")
    rows = rows.withColumn("_ring_part", F.when(F.col("_ring_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("_ring_row"), F.col("_ring_parts"))).cast("long"))
    counts = rows.where("_ring_hot is not null").groupBy("_ring_cell", "_ring_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("_ring_cell").orderBy("_ring_part")) - F.col("n")
    starts = counts.select(F.col("_ring_cell").alias("_ring_c"), F.col("_ring_part").alias("_ring_p"), before.alias("_ring_before"))
    rank = F.row_number().over(Window.partitionBy("_ring_cell", "_ring_part").orderBy(*order, "_ring_row")) - 1
    rows = rows.withColumn("_ring_rank", rank).join(F.broadcast(starts), (F.col("_ring_cell") == F.col("_ring_c")) & (F.col("_ring_part") == F.col("_ring_p")), "left")
    return rows.withColumn("_ring_rank", F.col("_ring_rank") + F.coalesce("_ring_before", F.lit(0)))


def shard_table(df: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The shard listing of a table of texts: key, ``size`` (UTF-8 bytes plus
    16; a null text has none), ``text_crc32`` (of a null text: of no bytes),
    ``law`` ("rows": counts at most one apart), ``shard``, ``slot`` and
    ``grown_shard`` (null under this law). Repeated rows and null keys take slots
    like any others; texts of any length are measured by a map; an empty table
    stays empty; other columns are not read, so none can clash."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("doc_id"), (F.octet_length(content) + 16).cast("long").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"))
    return assign(rows, shards).select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
