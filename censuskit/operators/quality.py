"""Data-quality checks: expected vs observed values, spread within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURE = "Measure_Name"


def compare(expected: DataFrame, observed: DataFrame, keys, value: str, tol: float = 0.0,
            expected_value: str | None = None) -> DataFrame:
    """Per key: expected, observed, absolute difference and pass flag.

    Full outer join on the keys, so a key missing on either side is reported
    as a failure instead of passing vacuously.
    """
    keys = list(keys)
    e = expected.select(*keys, F.col(expected_value or value).cast("double").alias("Expected"))
    o = observed.select(*keys, F.col(value).cast("double").alias("Observed"))
    j = e.join(o, keys, "full_outer")
    diff = F.abs(F.col("Observed") - F.col("Expected"))
    return j.withColumn("Abs_Diff", diff).withColumn(
        "Passed", F.coalesce(F.col("Abs_Diff") <= F.lit(float(tol)), F.lit(False))
    )


def by_measure(df: DataFrame, keys, measures, name: str) -> DataFrame:
    """Measure columns as rows: ``keys``, ``Measure_Name`` and ``name``."""
    doubles = [F.col(m).cast("double").alias(m) for m in measures]
    return df.select(*keys, *doubles).unpivot(list(keys), list(measures), MEASURE, name)


def compare_measures(observed: DataFrame, expected: DataFrame, keys, measures) -> DataFrame:
    """Several measures of ``observed`` (a column each) against a table of
    expectations: ``keys``, ``Measure_Name``, ``Expected`` and ``Tolerance``.

    The measures are unpivoted once and full-outer-joined, so that one check
    serves all; what is missing on either side, or has no tolerance, fails.
    """
    keys = [*keys, MEASURE]
    found = by_measure(observed, keys[:-1], measures, "Observed").join(expected.select(*keys, "Expected", "Tolerance"), keys, "full_outer")
    diff = F.abs(F.col("Observed") - F.col("Expected"))
    return found.select(*keys, "Expected", "Observed", "Tolerance", diff.alias("Abs_Diff"), F.coalesce(diff <= F.col("Tolerance"), F.lit(False)).alias("Passed"))


def compare_columns(df: DataFrame, keys, expected: str, observed: str, tol: float = 0.0) -> DataFrame:
    """``compare`` for expected and observed values held in one frame: a
    projection, no join."""
    e = F.col(expected).cast("double")
    o = F.col(observed).cast("double")
    diff = F.abs(o - e)
    return df.select(
        *keys,
        e.alias("Expected"),
        o.alias("Observed"),
        diff.alias("Abs_Diff"),
        F.coalesce(diff <= F.lit(float(tol)), F.lit(False)).alias("Passed"),
    )


def summarize(checked: DataFrame, by=()) -> DataFrame:
    """Number of passed and failed checks (optionally per group)."""
    passed = F.col("Passed")
    return checked.groupBy(*by).agg(
        F.count(F.when(passed, 1)).alias("Passed_Count"),
        F.count(F.when(~passed, 1)).alias("Failed_Count"),
    )


def count_unexpected(df: DataFrame, keys, expected: int = 1, by=()) -> DataFrame:
    """Per ``by`` group: how many keys there are and how many do not occur
    exactly ``expected`` times."""
    by = list(by)
    counts = df.groupBy(*by, *[k for k in keys if k not in by]).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(
        F.count("*").alias("Keys"), F.count(F.when(F.col("_n") != F.lit(expected), 1)).alias("Unexpected")
    )


def spread_below(df: DataFrame, by, value: str, limit: float) -> DataFrame:
    """``max - min`` of ``value`` per group and whether it is below ``limit``
    (the study checked only one signed difference)."""
    by = list(by)
    spread = F.max(value) - F.min(value)
    return df.groupBy(*by).agg(spread.alias("Spread")).withColumn(
        "Passed", F.col("Spread") < F.lit(limit)
    )
