"""Distribution summaries (box-plot statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from censuskit.sources import storage

#: Histogram buckets of a group.
BUCKETS = 4_096
#: Groups (some 50 bytes each) whose bounds are broadcast; more are shuffled.
BROADCAST_GROUPS = 1_000_000


def quantiles_by_rank(df: DataFrame, by, value: str, probs, buckets: int = BUCKETS) -> DataFrame:
    """Exact quantiles (linear interpolation) per group, ``by`` and the array
    ``_q``, with no group in one task.

    A histogram between each group's least and greatest value tells which
    buckets hold the wanted ranks; only the rows of these are sorted, equal
    values counted first. Every stage aggregates before it shuffles, so a hot
    group costs a task ``buckets`` rows, or one bucket's values. Nulls and values
    that are not finite have no rank; rows with a null in ``by`` are left out.
    """
    by = list(by)
    v = F.col("_v")
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).dropna(subset=by)
    spans = storage.cut(rows.groupBy(*by).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.count("*").alias("_n")), "spans")
    small = spans.count() <= BROADCAST_GROUPS
    near = F.broadcast if small else (lambda x: x.hint("merge"))
    bucket = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((v - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * buckets), F.lit(buckets - 1))).otherwise(0)
    placed = rows.join(near(spans.drop("_n")), by).select(*by, "_v", bucket.cast("int").alias("_b"))
    histogram = placed.groupBy(*by, "_b").agg(F.count("*").alias("_c"))
    histogram = histogram.withColumn("_before", F.sum("_c").over(Window.partitionBy(*by).orderBy("_b")) - F.col("_c"))  # at most ``buckets`` rows
    at = [(F.col("_n") - 1) * float(p) for p in probs]
    ranks = spans.select(*by, F.explode(F.array_distinct(F.array(*[f(h).cast("long") for h in at for f in (F.floor, F.ceil)]))).alias("_rank"))
    wanted = histogram.join(ranks, by).where("_rank >= _before and _rank < _before + _c").select(*by, "_b", "_before", "_rank")
    wanted = storage.cut(wanted, "ranks")
    values = placed.join(near(wanted.select(*by, "_b").distinct()), [*by, "_b"], "left_semi").groupBy(*by, "_b", "_v").agg(F.count("*").alias("_c"))
    values = values.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by, "_b").orderBy("_v")))  # one bucket's values
    found = values.join(wanted, [*by, "_b"]).where("_rank < _before + _upto and _rank >= _before + _upto - _c")
    found = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_of"))  # two ranks a quantile
    out = []
    for h in at:
        low, high = (F.element_at("_of", f(h).cast("long")) for f in (F.floor, F.ceil))
        out.append(low + (high - low) * (h - F.floor(h)))
    return found.join(spans.select(*by, "_n"), by).select(*by, F.array(*out).alias("_q"))


def box_stats(df: DataFrame, by, value: str, approx: bool = False, accuracy: int = 10000,
              whisker: float = 1.5, by_rank: bool = False) -> DataFrame:
    """Quartiles, extremes, Tukey fences, whiskers and outlier count per group.

    Exact quartiles (``percentile``, linear interpolation) hold the group's
    values in one task. Where groups are large, ``by_rank=True`` finds the same
    quartiles by ``quantiles_by_rank``, and ``approx=True`` takes a mergeable
    sketch (``percentile_approx``). The
    whiskers and outlier count need the fences, so the per-group stats (one
    row per group) are joined to the values for a second aggregation.
    """
    by = list(by)
    if by_rank:  # read several times below: the values alone are written, once
        df = storage.cut(df.select(*by, F.col(value).cast("double").alias(value)), "values")
    probs = [0.25, 0.5, 0.75]
    q = (F.percentile_approx(value, probs, accuracy) if approx
         else F.percentile(F.col(value), F.array(*[F.lit(p) for p in probs])))
    stats = df.groupBy(*by).agg(
        *([] if by_rank else [q.alias("_q")]),
        F.min(value).alias("Min"),
        F.max(value).alias("Max"),
        F.count(value).alias("N"),
    )
    if by_rank:
        stats = storage.cut(stats.join(quantiles_by_rank(df, by, value, probs), by), "quartiles")
    stats = stats.select(
        *by,
        F.col("_q")[0].cast("double").alias("Q1"),
        F.col("_q")[1].cast("double").alias("Median"),
        F.col("_q")[2].cast("double").alias("Q3"),
        "Min",
        "Max",
        "N",
    )
    iqr = F.col("Q3") - F.col("Q1")
    stats = stats.withColumn("IQR", iqr).withColumn(
        "Lower_Fence", F.col("Q1") - F.lit(whisker) * F.col("IQR")
    ).withColumn("Upper_Fence", F.col("Q3") + F.lit(whisker) * F.col("IQR"))
    v = F.col(value)
    inside = (v >= F.col("Lower_Fence")) & (v <= F.col("Upper_Fence"))
    # One join of the values to their group's stats (one row per group); the
    # stats ride along through the tail aggregation, so they are computed
    # once and never joined back.
    carried = [c for c in stats.columns if c not in by]
    if by_rank and stats.count() <= BROADCAST_GROUPS:
        stats = F.broadcast(stats)
    return df.select(*by, value).join(stats, by).groupBy(*by).agg(
        *[F.max(c).alias(c) for c in carried],
        F.min(F.when(inside, v)).alias("Whisker_Low"),
        F.max(F.when(inside, v)).alias("Whisker_High"),
        F.count(F.when(v.isNotNull() & ~inside, v)).alias("Outliers"),
    )
