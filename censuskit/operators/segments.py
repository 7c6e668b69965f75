"""Rural/urban split, management mix and sector comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from censuskit.functions import sector_of
from censuskit.operators.rollup import mean
from censuskit.schema import (
    LOCATION,
    MGMT_ID,
    MGMT_NAME,
    PERIOD,
    RURAL,
    SECTORS,
    STATE,
    TOTAL,
    URBAN,
)

RURAL_COUNT = "Rural_School_Count"
URBAN_COUNT = "Urban_School_Count"
ALL_COUNT = "School_Count"
RATIO = "Urban_Rural_Ratio"


def split_totals(df: DataFrame, keys=(PERIOD, STATE), total: str = TOTAL) -> DataFrame:
    """Rural, urban and all schools per group in one conditional aggregation
    (a group lacking one side keeps its row, with null for that side)."""
    loc = F.col(LOCATION)
    return df.groupBy(*keys).agg(
        F.sum(F.when(loc == RURAL, F.col(total))).alias(RURAL_COUNT),
        F.sum(F.when(loc == URBAN, F.col(total))).alias(URBAN_COUNT),
        F.sum(total).alias(ALL_COUNT),
    )


def split_ratio(totals: DataFrame) -> DataFrame:
    """Urban/rural ratio (null when a side is missing or zero)."""
    return totals.withColumn(RATIO, F.try_divide(F.col(URBAN_COUNT), F.col(RURAL_COUNT)))


def mix(df: DataFrame, keys=(PERIOD, LOCATION, MGMT_ID, MGMT_NAME), total: str = TOTAL) -> DataFrame:
    """Schools per management type (one pass; partial aggregation replaces
    the study's per-state first stage)."""
    return df.groupBy(*keys).agg(F.sum(total).alias(ALL_COUNT))


def mix_share(mixed: DataFrame, within=(PERIOD, LOCATION), count: str = ALL_COUNT,
              min_label_pct: float = 2.0) -> DataFrame:
    """Share of each row in its ``within`` group, in percent, and a pie label
    (``%.2f``) that is empty at or below ``min_label_pct``.

    The window runs over the aggregated mix (one row per management type),
    so a window group is bounded by the number of management types.
    """
    share = F.try_divide(F.lit(100) * F.col(count), F.sum(count).over(Window.partitionBy(*within)))
    return mixed.withColumn("Share_Pct", share).withColumn(
        "Label",
        F.when(F.col("Share_Pct") > F.lit(min_label_pct), F.format_string("%.2f", F.col("Share_Pct")))
        .otherwise(F.lit("")),
    )


def sector_compare(scored: DataFrame, score, keys=(PERIOD, STATE), sectors=None,
                   scale: float = 100.0, require_all: bool = False,
                   suffix: str = "_Score") -> DataFrame:
    """Mean score per management id, then the unweighted mean over the ids of
    each sector, one column per sector (times ``scale``). ``score`` is the row
    score's column, or the columns of its sum and count (see ``rollup``).

    Sector membership is a CASE expression over the id (no join). With
    ``require_all`` a group lacking any sector is dropped (the study's
    behaviour, from joining one frame per sector); by default it keeps null.
    """
    sectors = sectors or SECTORS
    keys = list(keys)
    id_mean = F.avg(score) if isinstance(score, str) else mean(score)
    per_id = scored.groupBy(*keys, MGMT_ID).agg(id_mean.alias("_id_mean"))
    per_id = per_id.withColumn("_sector", sector_of(F.col(MGMT_ID), sectors))
    cols = [f"{s}{suffix}" for s in sectors]
    out = per_id.groupBy(*keys).agg(
        *[
            (F.avg(F.when(F.col("_sector") == F.lit(s), F.col("_id_mean"))) * F.lit(scale)).alias(c)
            for s, c in zip(sectors, cols)
        ]
    )
    if require_all:
        out = out.dropna(subset=cols)
    return out
