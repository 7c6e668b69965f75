"""Mixing sources to target weights, as a curriculum that changes with time.

Every source has a schedule: its weight over training time from 0 to 1, straight
between knots. The schedule's integral is the source's weight in the mix; from
these weights come the words that each source is to give (``targets``). A
source's cumulative demand follows its integrated schedule, so inverting it
turns the number of words read before a document into the document's training
position; sorting all sources by position (``in_order``) interleaves them as
scheduled.

A source reads its documents in the order of a digest of key and text, pass
after pass, until its target is met; the last document is read as far as the
demand reaches. The words before a document are prefix sums in two levels: sums
of about ``sqrt(n)`` ranges of digests, then rows within a range. Rows alike
are counted before they are shuffled and told apart after. Everything is
DataFrame or SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, shuffle_partitions

#: Words are longest runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A source gives at most this many times its words.
MOST_PASSES = 3
#: Alike rows are told apart in runs of this many, dealt to different tasks.
RUN = 10_000
#: Schedules by the weight of a class of sources, as (time, weight) knots: the
#: first fades, the second stays, the third grows; integrals 1, 2 and 3.
FADING, STEADY, GROWING = ((0.0, 1.5), (1.0, 0.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 2.0), (0.5, 3.0), (1.0, 4.0))


def words(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def rotating_schedule(df: DataFrame, source: str = "source", classes=(FADING, STEADY, GROWING)) -> DataFrame:
    """Knots ``(source, at, weight)`` that give the sources of ``df``, by code
    point and null last, the ``classes`` in turn. One row per source is ranked."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = df.select(F.col(source).alias("source")).distinct().withColumn("class", (rank % len(classes)).cast("int"))
    knots = F.array(*[F.array(*[F.struct(F.lit(t).alias("at"), F.lit(w).alias("weight")) for t, w in knots]) for knots in classes])
    return listed.select("source", F.explode(F.get(knots, F.col("class"))).alias("knot")).select("source", "knot.at", "knot.weight")


def integrated(schedule: DataFrame) -> DataFrame:
    """Per source of ``schedule`` (``source``, ``at``, ``weight``): ``weight``,
    the integral of its schedule over times 0 to 1, and ``segments`` (``from``,
    ``length``, ``w0``, ``w1``, ``area`` before it) that go up.

    Weights are straight between knots and level before the first and after the
    last. Of knots at one time the largest weight counts; weights below zero,
    null or not finite count as zero; knots with a null time or one outside 0
    to 1 are left out. A source without knots is absent."""
    good = F.col("weight").isNotNull() & ~F.isnan("weight") & (F.col("weight") > 0) & (F.col("weight") < float("inf"))
    knots = schedule.select("source", F.col("at").cast("double").alias("at"), F.when(good, F.col("weight").cast("double")).otherwise(F.lit(0.0)).alias("w"))
    knots = knots.where("at between 0 and 1").groupBy("source", "at").agg(F.max("w").alias("w"))
    by_source = knots.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("at", "w"))).alias("k"))  # the knots that a caller gives
    level = "concat(array(named_struct('at', 0D, 'w', k[0].w)), filter(k, x -> x.at > 0 and x.at < 1), array(named_struct('at', 1D, 'w', k[size(k) - 1].w)))"
    pieces = by_source.select("source", F.expr(level).alias("k")).select(
        "source",
        F.expr("transform(sequence(1, size(k) - 1), i -> named_struct('from', k[i-1].at, 'length', k[i].at - k[i-1].at, 'w0', k[i-1].w, 'w1', k[i].w))").alias("s"),
    )
    area = "(s[i].w0 + s[i].w1) * s[i].length / 2D"
    summed = f"""transform(sequence(0, size(s) - 1), i -> named_struct('from', s[i].from, 'length', s[i].length, 'w0', s[i].w0, 'w1', s[i].w1,
      'area', aggregate(sequence(0, i), 0D, (a, j) -> if(j < i, a + (s[j].w0 + s[j].w1) * s[j].length / 2D, a))))"""
    return pieces.select("source", F.expr(f"aggregate(sequence(0, size(s) - 1), 0D, (a, i) -> a + {area})").alias("weight"), F.expr(summed).alias("segments"))


def targets(sizes: DataFrame, weights: DataFrame, most: int = MOST_PASSES) -> DataFrame:
    """Per source of ``sizes`` (``source``, ``source_size``, ...): ``target``.

    Sources share the sum of all sizes by weight; a target stops at ``most``
    times its source's size and the excess is shared by weight among the others
    until none is above. That is ``least(cap, weight * level)`` with one
    ``level`` for all, found from prefix sums in the order in which caps are
    met. A source without a weight has target zero; if all sources with one are
    at their caps, the sum falls short. One row per source is sorted."""
    joined = sizes.alias("n").join(weights.alias("w"), F.expr("n.source <=> w.source"), "left").select("n.*", F.coalesce("w.weight", F.lit(0.0)).alias("weight"), "w.segments")
    joined = joined.withColumn("cap", F.col("source_size") * most)
    every, met = Window.partitionBy(F.col("weight") > 0), Window.partitionBy(F.col("weight") > 0).orderBy(F.try_divide("cap", "weight"), "source")
    shared = F.sum("source_size").over(Window.partitionBy())
    rest = shared - (F.sum("cap").over(met) - F.col("cap"))
    joined = joined.withColumn("level", F.try_divide(rest, F.sum("weight").over(met.rowsBetween(0, Window.unboundedFollowing))))
    level = F.coalesce(F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(every), F.lit(float("inf")))
    target = F.when(F.col("weight") > 0, F.least(F.col("cap").cast("double"), F.col("weight") * level)).otherwise(F.lit(0.0))
    return joined.withColumn("target", target).drop("cap", "level")


def position(offset: str) -> str:
    """SQL for the time at which a source has given ``offset`` of its ``target``
    words: the inverse of its integrated schedule (``segments``, ``weight``)."""
    area = f"(cast({offset} as double) / target * weight)"
    segment = f"element_at(filter(segments, s -> s.area <= {area} and s.w0 + s.w1 > 0), -1)"
    rest = f"({area} - g.area)"
    x = f"2D * {rest} / (g.w0 + sqrt(g.w0 * g.w0 + 2D * ((g.w1 - g.w0) / g.length) * {rest}))"
    return f"element_at(transform(array({segment}), g -> g.from + if({rest} > 0D, least(g.length, {x}), 0D)), 1)"


def plan(df: DataFrame, schedule: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", most: int = MOST_PASSES) -> DataFrame:
    """What the mix takes of every row of ``df``: ``key``, ``source``, ``size``
    (words), ``source_size``, ``target`` (its source's), ``taken`` (words,
    repeats counted), ``reads`` (an array, pass by pass, of ``turn`` from 0,
    ``words`` and ``position``) and ``order`` (a digest of key and text).

    A source's taken words are its target, rounded; no row gives more than
    ``most`` times its size. Rows are read in digest order. A null text has no
    words, a row without words is never read, and a null key is like any other
    value. Repeated rows count each and are interchangeable; rows of one key
    with other texts are rows of their own. A null source is a source. Texts of
    any length are read once, by a map. An empty table stays empty; other
    columns are not read, so none can clash. Reruns agree.
    """
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))).cast("binary"))
    rows = df.select(F.col(key).alias("key"), F.col(source).alias("source"), words(text).alias("size"), digest.alias("order"))
    alike = cut(rows.groupBy("source", "order", "key", "size").agg(F.count("*").alias("n")), "mix-rows")
    sizes = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    aims = cut(targets(sizes, integrated(schedule), most), "mix-targets")
    run = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN)))
    runs = alike.select("*", run.alias("run")).withColumn("n", F.least(F.col("n") - F.col("run") * RUN, F.lit(RUN)))
    ranges = aims.select(F.col("source").alias("_source"), F.ceil(F.sqrt("rows")).alias("ranges"))
    runs = runs.join(ranges, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    runs = runs.withColumn("range", F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * F.col("ranges"), 32)).drop("ranges")
    sums = runs.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("n")).alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("range")) - F.col("sum")  # about sqrt(n) rows a source
    bases = sums.select(F.col("source").alias("_source"), F.col("range").alias("_range"), before.alias("base"))
    placed = runs.join(bases, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))).drop("_source", "_range")
    within = Window.partitionBy("source", "range").orderBy("order", "key", "size", "run")
    placed = placed.withColumn("start", F.col("base") + F.sum(F.col("size") * F.col("n")).over(within) - F.col("size") * F.col("n"))
    placed = placed.select("key", "source", "size", "order", "run", "n", "start").repartition(shuffle_partitions(df.sparkSession), "order", "run")
    each = placed.select("*", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("copy")).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    each = each.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    # Words of the whole mix that the source gives, in full passes and a part of one.
    each = each.withColumn("goal", F.floor(F.col("target") + 0.5)).withColumn("turns", F.expr("if(source_size > 0, goal div source_size, 0)"))
    each = each.withColumn("rest", F.least("size", F.greatest(F.lit(0), F.col("goal") - F.col("turns") * F.col("source_size") - F.col("start"))))
    at = position("t * source_size + start")
    reads = f"""transform(if(size = 0, cast(array() as array<bigint>), filter(sequence(0L, turns), t -> t < turns or rest > 0)),
      t -> named_struct('turn', cast(t as int), 'words', if(t < turns, size, rest), 'position', {at}))"""
    return each.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        (F.col("turns") * F.col("size") + F.when(F.col("size") > 0, F.col("rest")).otherwise(0)).alias("taken"), F.expr(reads).alias("reads"), "order", (F.col("run") * RUN + F.col("copy")).alias("copy"),
    )


def sort_by_position(df: DataFrame, column: str = "position") -> DataFrame:
    """Rows that have ``order`` and ``copy`` from ``plan``, in the order of
    ``column`` over all partitions, nulls last: partitions are ranges. Rows at
    one position, such as rows never read, are split by ``order`` and ``copy``."""
    by = [F.col(column).asc_nulls_last(), F.col("order"), F.col("copy")]
    return df.repartitionByRange(shuffle_partitions(df.sparkSession), *by).sortWithinPartitions(*by)


def curriculum(df: DataFrame, schedule: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", most: int = MOST_PASSES) -> DataFrame:
    """The training sequence of ``plan``, sorted by position: ``position`` (0 to
    1), ``key``, ``source``, ``turn`` (the pass, from 0) and ``words`` (the first
    of the text, all but for a source's last). Rows and odd values as there."""
    planned = plan(df, schedule, key, source, text, most)
    listed = planned.select(key, source, "order", "copy", F.explode("reads").alias("read"))
    return sort_by_position(listed.select("read.position", key, source, "read.turn", "read.words", "order", "copy")).drop("order", "copy")


def document_mix(df: DataFrame, schedule: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", most: int = MOST_PASSES) -> DataFrame:
    """``plan`` by document, sorted by the position of its first read (null and
    last: never read): ``key``, ``size``, ``source_size``, ``target``, ``taken``
    and ``first_position``."""
    planned = plan(df, schedule, key, source, text, most).withColumn("first_position", F.get("reads", F.lit(0))["position"])
    return sort_by_position(planned, "first_position").select(key, "size", "source_size", "target", "taken", "first_position")


MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS ord FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
classes AS (
  SELECT source, source_size, 3 * source_size AS cap, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM sizes),
levels AS (
  SELECT *, (total - CAST(sum(cap) OVER met - cap AS DOUBLE)) / sum(weight) OVER (met ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM classes WINDOW met AS (ORDER BY cap / weight, source)),
aims AS (
  SELECT source, source_size, weight, least(CAST(cap AS DOUBLE), weight * max(level) FILTER (level * weight <= cap) OVER ()) AS target FROM levels),
placed AS (
  SELECT r.doc_id, r.size, a.source_size, a.target, a.weight, CAST(floor(a.target + 0.5) AS BIGINT) AS goal,
         CAST(sum(r.size) OVER (PARTITION BY r.source ORDER BY ord ROWS UNBOUNDED PRECEDING) - r.size AS BIGINT) AS start
  FROM rows r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source),
turns AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS turns FROM placed),
takes AS (
  SELECT *, turns * size + least(size, greatest(0, goal - turns * source_size - start)) AS taken,
         CASE WHEN target > 0 THEN CAST(start AS DOUBLE) / target * weight END AS area FROM turns),
pieces AS (
  SELECT *, CASE WHEN weight = 3 AND area >= 1.25 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS t0, CASE WHEN weight = 3 THEN 0.5::DOUBLE ELSE 1::DOUBLE END AS length,
         CASE weight WHEN 1 THEN 1.5::DOUBLE WHEN 2 THEN 2::DOUBLE ELSE CASE WHEN area >= 1.25 THEN 3::DOUBLE ELSE 2::DOUBLE END END AS w0,
         CASE weight WHEN 1 THEN -1::DOUBLE WHEN 2 THEN 0::DOUBLE ELSE 2::DOUBLE END AS slope,
         area - CASE WHEN weight = 3 AND area >= 1.25 THEN 1.25::DOUBLE ELSE 0::DOUBLE END AS rest FROM takes)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN t0 + CASE WHEN rest > 0 THEN least(length, 2::DOUBLE * rest / (w0 + sqrt(w0 * w0 + 2::DOUBLE * slope * rest))) ELSE 0 END END AS first_position
FROM pieces
"""
