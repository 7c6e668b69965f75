"""Sufficient statistics of a census: one scan, from which every analysis is
rolled up.

Every rate, share, score, ranking and trend of the study is a function of sums:
schools, facilities, gaps (``total - measure``, of rows that have the measure)
and row scores with their counts. ``facts`` writes a row's own values under the
names of these sums, and ``rollup`` adds them up by the census keys, so both,
and any coarser rollup, serve the same analyses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censuskit.functions import ratio_weighted_sum, scaled_weighted_sum
from censuskit.schema import DISTRICT, HYGIENE_WEIGHTS, LOCATION, MEASURES, MGMT_ID, MGMT_NAME, PERIOD, STATE, SUSTAINABILITY_WEIGHTS, TOTAL

KEYS = [PERIOD, STATE, DISTRICT, LOCATION, MGMT_ID, MGMT_NAME]
ROWS = "_rows"
#: Measures whose gap is summed row by row.
GAP_MEASURES = ["Ramps"]
#: Sum and count of each row score.
SUSTAIN = ("_sustain_sum", "_sustain_n")
HYGIENE = ("_hygiene_sum", "_hygiene_n")


def gap(measure: str) -> str:
    """The column with the gaps of ``measure``."""
    return f"_gap_{measure}"


def _statistics(columns) -> dict[str, Column]:
    """What is summed, as expressions on census rows; measures that the rows
    lack are left out, with the scores that need them."""
    have = set(columns)
    out = {ROWS: F.lit(1).cast("long")}
    if TOTAL not in have:
        return out
    out[TOTAL] = F.col(TOTAL)
    out |= {m: F.col(m) for m in MEASURES if m in have}
    out |= {gap(m): F.col(TOTAL) - F.col(m) for m in GAP_MEASURES if m in have}
    for (total, n), weights, score in ((SUSTAIN, SUSTAINABILITY_WEIGHTS, ratio_weighted_sum), (HYGIENE, HYGIENE_WEIGHTS, scaled_weighted_sum)):
        if {m for m, _ in weights} <= have:
            value = score(weights, TOTAL)
            out |= {total: value, n: F.when(value.isNotNull(), 1).otherwise(0).cast("long")}
    return out


def facts(df: DataFrame) -> DataFrame:
    """A census with every row's own statistics; a rollup as it is. They are
    plain expressions: an analysis computes those that it sums."""
    if ROWS in df.columns:
        return df
    statistics = _statistics(df.columns)
    return df.select(*[c for c in df.columns if c not in statistics], *[e.alias(n) for n, e in statistics.items()])


def rollup(df: DataFrame, keys=None) -> DataFrame:
    """The statistics of a census, or of a finer rollup, summed by ``keys`` (by
    default all census keys that it has): as many rows as there are key values,
    however many rows the census has. Sums of nulls alone stay null."""
    rows = facts(df)
    keys = [k for k in (KEYS if keys is None else keys) if k in rows.columns]
    sums = [c for c in rows.columns if c in _statistics(rows.columns) or c in (*SUSTAIN, *HYGIENE) or c.startswith("_gap_")]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def mean(statistic: tuple[str, str]) -> Column:
    """The mean of a row score over a group: null where no row has one."""
    total, n = statistic
    return F.try_divide(F.sum(total), F.sum(n))
