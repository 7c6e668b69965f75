"""Facility features against an outcome: join, correlations, extremes, fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from censuskit.functions import pearson, round6

FEATURE = "Feature"
CORRELATION = "Correlation"


def join_outcome(features: DataFrame, outcome: DataFrame, feature_key: str, outcome_key: str,
                 feature_period: str, outcome_period: str, period_map=None, state: str | None = None) -> DataFrame:
    """Inner equi-join of per-district features with the outcome on
    (district key, period). ``period_map`` turns the feature period into the
    outcome's period label (default: the part before the first ``_``, so
    ``2017_2018`` meets exam year ``2017``).

    ``state`` names the features' column that tells equal district names apart.
    If the outcome has that column, too, it is a third key. If not, a name that
    stands in several states of a period is an error when the join runs: it
    would meet the outcome of another state's district.
    """
    pm = period_map or (lambda c: F.substring_index(c, "_", 1))
    left = features.withColumn("_join_period", pm(F.col(feature_period))).withColumn("_join_key_l", F.col(feature_key))
    qualified = state is not None and state in outcome.columns
    if state is not None and not qualified:
        # One row per district and period: a window group is a name's states.
        same = Window.partitionBy(feature_key, "_join_period")
        several = F.min(state).over(same) != F.max(state).over(same)
        error = F.raise_error(F.concat(F.lit("district name in several states: "), F.col(feature_key))).cast("string")
        left = left.withColumn("_join_key_l", F.when(several, error).otherwise(F.col(feature_key)))
    extra = [c for c in outcome.columns if c not in (outcome_key, outcome_period, state)]
    right = outcome.select(
        F.col(outcome_key).alias("_join_key"), F.col(outcome_period).alias("_join_period_r"), *extra,
        *([F.col(state).alias("_join_state")] if qualified else []),
    )
    on = (left["_join_key_l"] == right["_join_key"]) & (left["_join_period"] == right["_join_period_r"])
    if qualified:
        on = on & (left[state] == right["_join_state"])
    joined = left.join(right, on)
    return joined.select(*[left[c] for c in features.columns], *[right[c] for c in extra])


def feature_correlations(df: DataFrame, by, features, target: str, null_policy: str = "skip") -> DataFrame:
    """Pearson correlation of each feature with ``target`` per group, long
    form (by..., Feature, Correlation): the rows are unpivoted to (by, feature,
    value) first, so that one small aggregate per group and feature suffices.

    ``null_policy="skip"`` uses the pairs where both values are present;
    ``"zero"`` counts a missing value as 0 (what ``DataFrame.stat.corr``
    gives on Spark 4.1, the study's numbers).
    """
    by = list(by)
    if null_policy == "zero":
        df = df.na.fill(0, subset=[*features, target])
    elif null_policy != "skip":
        raise ValueError(f"unknown null_policy {null_policy!r}")
    doubles = df.select(*by, F.col(target).alias("_target"), *[F.col(f).cast("double").alias(f) for f in features])
    long = doubles.unpivot([*by, "_target"], list(features), FEATURE, "_value")
    return long.groupBy(*by, FEATURE).agg(pearson("_value", "_target").alias(CORRELATION))


def extremes(corr: DataFrame, features, order_col: str, value: str = CORRELATION) -> DataFrame:
    """Feature with the largest and with the smallest (rounded) correlation
    over all groups.

    Ties go to the first in (``order_col``, then ``features`` order), for both
    ends; null correlations are skipped. The ``min`` of a struct per end: a
    partial + final aggregate, no sort and no window.
    """
    f_pos = F.array_position(F.array(*[F.lit(f) for f in features]), F.col(FEATURE))
    v = round6(value)
    tie = [F.col(order_col).alias("p"), f_pos.alias("o"), F.col(FEATURE).alias("f")]
    out = corr.where(F.col(value).isNotNull()).agg(
        F.min(F.struct((-v).alias("n"), *tie, v.alias("v"))).alias("_mx"),
        F.min(F.struct(v.alias("v"), *tie)).alias("_mn"),
    )
    return out.select(
        F.col("_mx.f").alias("Max_Feature"),
        F.col("_mx.p").alias(f"Max_{order_col}"),
        F.col("_mx.v").alias("Max_Correlation"),
        F.col("_mn.f").alias("Min_Feature"),
        F.col("_mn.p").alias(f"Min_{order_col}"),
        F.col("_mn.v").alias("Min_Correlation"),
    )


def fit_line(df: DataFrame, by, x: str, y: str) -> DataFrame:
    """Least-squares line ``y = Slope * x + Intercept`` and R² per group
    (``regr_*`` aggregates; null when x is constant)."""
    return fit_lines(df, by, [x], y).drop(FEATURE)


def fit_lines(df: DataFrame, by, features, y: str) -> DataFrame:
    """``fit_line`` for several features in one aggregation, long form
    (by..., Feature, Slope, Intercept, R2, N)."""
    by = list(by)
    yy = F.col(y).cast("double")
    aggs = []
    for i, f in enumerate(features):
        xx = F.col(f).cast("double")
        aggs += [
            F.regr_slope(yy, xx).alias(f"_s{i}"),
            F.regr_intercept(yy, xx).alias(f"_i{i}"),
            F.regr_r2(yy, xx).alias(f"_r{i}"),
            F.regr_count(yy, xx).alias(f"_n{i}"),
        ]
    wide = df.groupBy(*by).agg(*aggs)
    structs = [
        F.struct(F.lit(f).alias(FEATURE), F.col(f"_s{i}").alias("Slope"), F.col(f"_i{i}").alias("Intercept"),
                 F.col(f"_r{i}").alias("R2"), F.col(f"_n{i}").alias("N"))
        for i, f in enumerate(features)
    ]
    return wide.select(*by, F.explode(F.array(*structs)).alias("_fit")).select(*by, "_fit.*")
