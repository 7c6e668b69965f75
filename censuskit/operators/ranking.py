"""Top-n and above-mean rankings with fixed tie keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANK = "Rank"


def top_n(df: DataFrame, order, n: int = 10, by=()) -> DataFrame:
    """First ``n`` rows by ``order`` (Columns; put tie keys last), overall or
    within each group of ``by``; adds ``Rank`` (1-based).

    Overall: ``orderBy().limit()`` plans as TakeOrderedAndProject (per-task
    top-n, then a merge of n rows per task). Per group: ``row_number() <= n``
    lets Spark insert a partial WindowGroupLimit before the shuffle, so each
    task forwards at most n rows per group.
    """
    by = list(by)
    if not by:
        top = df.orderBy(*order).limit(n)
        return top.withColumn(RANK, F.row_number().over(Window.orderBy(*order)))
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(w)).where(F.col(RANK) <= n)


def above_group_mean(df: DataFrame, value: str, by=(), mean_name: str = "Mean",
                     compare=None) -> DataFrame:
    """Rows whose ``value`` exceeds the mean of ``value`` over their group.

    With group keys the mean is a grouped aggregate joined back on the keys
    (one row per group, broadcast by AQE). Without keys it is a scalar
    subquery evaluated once. ``compare`` maps (value, mean) Columns to the
    columns actually compared (e.g. both rounded).
    """
    by = list(by)
    if by:
        means = df.groupBy(*by).agg(F.avg(value).alias(mean_name))
        joined = df.join(means, by, "inner")
    else:
        joined = df.withColumn(mean_name, df.select(F.avg(value)).scalar())
    v, m = F.col(value), F.col(mean_name)
    if compare is not None:
        v, m = compare(v), compare(m)
    return joined.where(v > m)
