"""Facility availability rates (truncated integer percentages).

Each rate form of the study is kept as its own function because the forms
disagree on nulls and near integers:

* ``rate_gap_of_sums``: ``int(100*(1-(sum(t)-sum(f))/sum(t)))`` (essentials,
  advanced facilities, library);
* ``rate_gap_of_rows``: ``int(100*(1-sum(t-f)/sum(t)))`` (accessibility; a row
  with a null measure drops out of the gap but not of the total);
* ``lack_rate``: ``int(100*((t-f)/t))``; ``have_rate``: ``int(100*(f/t))``.

All are one grouped aggregation (partial + final hash aggregate, so a hot key
is combined map-side) followed by a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censuskit.functions import pct_gap_of_sums, pct_have, pct_lack
from censuskit.schema import TOTAL

_FORMS = {"gap_of_sums": pct_gap_of_sums, "lack": pct_lack, "have": pct_have}


def _as_map(measures) -> dict:
    if isinstance(measures, dict):
        return dict(measures)
    return {m: m for m in measures}


def facility_rates(df: DataFrame, keys, measures, form: str = "gap_of_sums",
                   total: str = TOTAL, keep_sums: bool = False) -> DataFrame:
    """Percentage per group for each measure (``measures``: list of columns or
    dict output name -> column)."""
    keys = list(keys)
    mm = _as_map(measures)
    pct = _FORMS[form]
    sums = df.groupBy(*keys).agg(
        F.sum(total).alias("_total"),
        *[F.sum(src).alias(f"_s_{out}") for out, src in mm.items()],
    )
    cols = [F.col(k) for k in keys]
    if keep_sums:
        cols.append(F.col("_total").alias(total))
    cols += [pct("_total", f"_s_{out}").alias(out) for out in mm]
    return sums.select(*cols)


def rate_gap_of_sums(df, keys, measures, total=TOTAL):
    return facility_rates(df, keys, measures, "gap_of_sums", total)


def lack_rate(df, keys, measure, name, total=TOTAL):
    return facility_rates(df, keys, {name: measure}, "lack", total)


def have_rate(df, keys, measure, name, total=TOTAL):
    return facility_rates(df, keys, {name: measure}, "have", total)


def rate_gap_of_rows(df: DataFrame, keys, measure: str, name: str, total: str = TOTAL,
                     gap: str | None = None) -> DataFrame:
    """``int(100 * (1 - sum(total - measure) / sum(total)))`` per group. ``gap``
    names a column that holds the gaps already (of a rollup)."""
    keys = list(keys)
    sums = df.groupBy(*keys).agg(
        F.sum(total).alias("_total"),
        F.sum(F.col(gap) if gap else F.col(total) - F.col(measure)).alias("_gap"),
    )
    pct = (F.lit(100) * (F.lit(1) - F.try_divide(F.col("_gap"), F.col("_total")))).cast("int")
    return sums.select(*keys, pct.alias(name))


def rate_forms(df: DataFrame, keys, measure: str, total: str = TOTAL, gap: str | None = None) -> DataFrame:
    """Both accessibility forms of one measure from a single aggregation:
    ``Gap_Of_Sums_Pct`` and ``Gap_Of_Rows_Pct`` (they differ only where null
    measures drop rows out of the gap but not out of the total)."""
    keys = list(keys)
    sums = df.groupBy(*keys).agg(
        F.sum(total).alias("_total"),
        F.sum(measure).alias("_have"),
        F.sum(F.col(gap) if gap else F.col(total) - F.col(measure)).alias("_gap"),
    )
    rows_pct = (F.lit(100) * (F.lit(1) - F.try_divide(F.col("_gap"), F.col("_total")))).cast("int")
    return sums.select(
        *keys,
        pct_gap_of_sums("_total", "_have").alias("Gap_Of_Sums_Pct"),
        rows_pct.alias("Gap_Of_Rows_Pct"),
    )


def with_complement(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``100 - column`` (the other half of a stacked bar)."""
    return df.withColumn(name, F.lit(100) - F.col(column))
