"""Multi-period trend tables."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def periods_of(df: DataFrame, period: str) -> list[str]:
    """The periods that occur, sorted: one row per period reaches the driver."""
    return sorted(r[0] for r in df.select(period).where(F.col(period).isNotNull()).distinct().collect())


def listed(period: str, periods) -> F.Column:
    """``period``, or an error at run time for a value that is not listed:
    rows of an unlisted period never vanish silently."""
    p = F.col(period)
    problem = F.raise_error(F.concat(F.lit("period not listed: "), p)).cast("string")
    return F.when(p.isNull() | p.isin(*periods), p).otherwise(problem)


def wide_by_period(df: DataFrame, keys, period: str, value: str, periods=None,
                   complete_only: bool = True) -> DataFrame:
    """Long (keys, period, value) to one column per period.

    A conditional aggregation with an explicit period list (what ``pivot``
    with given values plans to), plus a presence flag per period:
    ``complete_only`` keeps only keys present in every period (the study
    joined the yearly tables inner). ``periods`` defaults to those that occur
    in ``df``; a period outside a given list is an error.
    """
    periods = list(periods or periods_of(df, period))
    keys = list(keys)
    p = F.col("_period")
    df = df.withColumn("_period", listed(period, periods))
    values = [F.max(F.when(p == F.lit(v), F.col(value))).alias(v) for v in periods]
    flags = [F.max(F.when(p == F.lit(v), F.lit(1)).otherwise(F.lit(0))) for v in periods]
    wide = df.groupBy(*keys).agg(*values, reduce(add, flags, F.lit(0)).alias("_present"))
    if complete_only:
        wide = wide.where(F.col("_present") == F.lit(len(periods)))
    return wide.drop("_present")
