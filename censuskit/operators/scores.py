"""Weighted composite scores and their unweighted means.

Score means are means of ratios at every level (rows -> district -> state,
rows -> management id -> sector), as in the study; they are not
school-weighted. Every stage is a partial+final hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censuskit.functions import ratio_weighted_sum, scaled_weighted_sum
from censuskit.operators.rollup import mean
from censuskit.schema import HYGIENE_WEIGHTS, SUSTAINABILITY_WEIGHTS, TOTAL

ROW_SCORE = "_row_score"


def weighted_score(df: DataFrame, weights, total: str = TOTAL, form: str = "ratio",
                   name: str = ROW_SCORE) -> DataFrame:
    """Row-level score. ``ratio``: sum of (measure/total)*w; ``scaled``:
    100*sum(measure*w)/total."""
    if form == "ratio":
        expr = ratio_weighted_sum(weights, total)
    elif form == "scaled":
        expr = scaled_weighted_sum(weights, total)
    else:
        raise ValueError(f"unknown form {form!r}")
    return df.withColumn(name, expr)


def sustainability_rows(df: DataFrame, name: str = ROW_SCORE) -> DataFrame:
    return weighted_score(df, SUSTAINABILITY_WEIGHTS, form="ratio", name=name)


def hygiene_rows(df: DataFrame, name: str = ROW_SCORE) -> DataFrame:
    return weighted_score(df, HYGIENE_WEIGHTS, form="scaled", name=name)


def district_score(df: DataFrame, keys, score: str = ROW_SCORE, name: str = "Score",
                   scale: float | None = None) -> DataFrame:
    """Mean of the row score per group, optionally times ``scale``."""
    agg = F.avg(score)
    if scale is not None:
        agg = agg * F.lit(float(scale))
    return df.groupBy(*keys).agg(agg.alias(name))


def score_of_sums(df: DataFrame, keys, statistic: tuple[str, str], name: str = "Score",
                  scale: float | None = None) -> DataFrame:
    """``district_score`` from the sum and count of a row score (see ``rollup``)."""
    out = mean(statistic)
    if scale is not None:
        out = out * F.lit(float(scale))
    return df.groupBy(*keys).agg(out.alias(name))


def group_mean(df: DataFrame, keys, value: str, name: str | None = None) -> DataFrame:
    """Unweighted mean of ``value`` per group (mean of means)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name or value))
