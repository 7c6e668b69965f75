"""Fixture generators with known answers (validation inputs).

Every table is produced by ``spark.range`` plus column arithmetic: no
driver-side row loops, no ``createDataFrame`` of generated rows, so a fixture
of any size is generated in parallel. Row ``i`` of a segment is fully
determined by ``i``, which makes each fixture deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from censuskit.functions import value_map
from censuskit.schema import (
    DISTRICT,
    LOCATION,
    MANAGEMENT_NAMES,
    MGMT_ID,
    MGMT_NAME,
    PERIOD,
    RURAL,
    STATE,
    TOTAL,
    URBAN,
)

# Configurations of the validation study.
SPLIT_SHARES = {
    "A": {"Rural": 0.4, "Urban": 0.6},
    "B": {"Rural": 0.7, "Urban": 0.3},
    "C": {"Rural": 0.8, "Urban": 0.2},
}
FACILITY_RATES = {
    "A": {"Functional_Electricity": 0.7, "Playground": 0.8, "Library_or_Reading_Corner_or_Book_Bank": 0.45,
          "Newspaper": 0.30, "Functional_Boy_Toilet": 0.70, "Functional_Girl_Toilet": 0.80,
          "Functional_Toilet_Facility": 0.85, "Functional_Urinal_Boy": 0.85, "Functional_Urinal_Girl": 0.70,
          "Functional_Urinal": 0.80, "Functional_Toilet_and_Urinal": 0.85, "Functional_Drinking_Water": 0.40,
          "Water_Purifier": 0.25, "Handwash": 0.60, "Ramps": 0.11, "Internet": 0.15, "Computer_Available": 0.20},
    "B": {"Functional_Electricity": 0.6, "Playground": 0.7, "Library_or_Reading_Corner_or_Book_Bank": 0.35,
          "Newspaper": 0.20, "Functional_Boy_Toilet": 0.60, "Functional_Girl_Toilet": 0.70,
          "Functional_Toilet_Facility": 0.75, "Functional_Urinal_Boy": 0.75, "Functional_Urinal_Girl": 0.60,
          "Functional_Urinal": 0.70, "Functional_Toilet_and_Urinal": 0.75, "Functional_Drinking_Water": 0.30,
          "Water_Purifier": 0.15, "Handwash": 0.50, "Ramps": 0.09, "Internet": 0.10, "Computer_Available": 0.15},
    "C": {"Functional_Electricity": 0.5, "Playground": 0.6, "Library_or_Reading_Corner_or_Book_Bank": 0.25,
          "Newspaper": 0.10, "Functional_Boy_Toilet": 0.50, "Functional_Girl_Toilet": 0.60,
          "Functional_Toilet_Facility": 0.65, "Functional_Urinal_Boy": 0.65, "Functional_Urinal_Girl": 0.50,
          "Functional_Urinal": 0.60, "Functional_Toilet_and_Urinal": 0.65, "Functional_Drinking_Water": 0.20,
          "Water_Purifier": 0.05, "Handwash": 0.40, "Ramps": 0.65, "Internet": 0.05, "Computer_Available": 0.10},
}
HYGIENE_CONSTANTS = {
    # total, toilet, urinal, drinking water, purifier, tested, handwash
    "A": [1, 1, 1, 1, 1, 1, 0],
    "B": [1, 1, 1, 1, 1, 0, 0],
    "C": [1, 1, 1, 1, 0, 1, 0],
}
HYGIENE_CONSTANT_COLUMNS = [TOTAL, "Functional_Toilet_Facility", "Functional_Urinal",
                            "Functional_Drinking_Water", "Water_Purifier", "Water_Tested", "Handwash"]
SUSTAIN_CONSTANTS = {
    # total, solar, garden, rain water, incinerator
    "A": [1, 1, 1, 1, 1],
    "B": [1, 1, 0, 1, 1],
    "C": [1, 1, 0, 1, 0],
}
SUSTAIN_CONSTANT_COLUMNS = [TOTAL, "Solar_Panel", "Kitchen_Garden", "Rain_Water_Harvesting", "Incinerator"]
MEDICAL_UNAVAILABLE = 0.7
FLAG_STRIDE = 7919  # prime: i -> (i * stride + k) % n is a bijection unless n is a multiple of it

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _letter(i: Column) -> Column:
    return F.substring(F.lit(_LETTERS), (i % 26 + 1).cast("int"), F.lit(1))


def _segments(spark: SparkSession, segs: list[tuple]) -> DataFrame:
    """One row per (segment, i) for i < segment length, from one
    ``spark.range``; the segment of a row id is found by its offset."""
    offsets, total = [], 0
    for s in segs:
        offsets.append(total)
        total += s[-1]
    rid = F.col("id")
    seg = None
    for k in range(len(segs)):
        cond = rid < F.lit(offsets[k] + segs[k][-1])
        seg = F.when(cond, F.lit(k)) if seg is None else seg.when(cond, F.lit(k))
    df = spark.range(total).withColumn("_seg", seg)
    df = df.withColumn("_i", rid - value_map(F.col("_seg"), dict(enumerate(offsets))))
    return df


def quota_split(spark: SparkSession, rows_per_state: int = 100, shares: dict | None = None,
                mgmt_ids: list[int] | None = None, period: str = "2019_2020") -> DataFrame:
    """Rural/urban quota per state; district ``a + i % 26`` and management id
    ``ids[i % len(ids)]`` with ``i`` counted per location; one school a row."""
    shares = shares or SPLIT_SHARES
    ids = sorted(mgmt_ids or MANAGEMENT_NAMES)
    segs = []
    for state, by_loc in shares.items():
        for loc in (RURAL, URBAN):
            segs.append((state, loc, int(rows_per_state * by_loc[loc])))
    df = _segments(spark, segs)
    seg = F.col("_seg")
    i = F.col("_i")
    mgmt = F.element_at(F.array(*[F.lit(x) for x in ids]), (i % len(ids) + 1).cast("int"))
    return df.select(
        value_map(seg, {k: s[0] for k, s in enumerate(segs)}).alias(STATE),
        _letter(i).alias(DISTRICT),
        value_map(seg, {k: s[1] for k, s in enumerate(segs)}).alias(LOCATION),
        value_map(mgmt, MANAGEMENT_NAMES).alias(MGMT_NAME),
        mgmt.cast("int").alias(MGMT_ID),
        F.lit(1).alias(TOTAL),
        F.lit(period).alias(PERIOD),
    )


def quota_flags(spark: SparkSession, rows_per_state: int = 10000, rates: dict | None = None) -> DataFrame:
    """One school per row; facility ``k`` is 1 on exactly
    ``int(rate * n)`` rows of a state, spread by ``(i * 7919 + k) % n``."""
    rates = rates or FACILITY_RATES
    states = list(rates)
    n = rows_per_state
    measures = list(next(iter(rates.values())))
    df = spark.range(len(states) * n).select(
        (F.col("id") / n).cast("int").alias("_s"), (F.col("id") % n).alias("_i")
    )
    cols = [value_map(F.col("_s"), dict(enumerate(states))).alias(STATE), F.lit(1).alias(TOTAL)]
    for k, m in enumerate(measures):
        quota = value_map(F.col("_s"), {j: int(rates[s][m] * n) for j, s in enumerate(states)})
        pos = (F.col("_i") * FLAG_STRIDE + k) % n
        cols.append(F.when(pos < quota, F.lit(1.0)).otherwise(F.lit(0.0)).alias(m))
    return df.select(*cols)


def constant_flags(spark: SparkSession, rows_per_state: int, values: dict, columns: list[str],
                   period: str = "2019_2020", with_location: bool = True) -> DataFrame:
    """``rows_per_state`` rows per state with constant column values;
    district ``a + i % 26``, location alternating Rural/Urban."""
    states = list(values)
    n = rows_per_state
    df = spark.range(len(states) * n).select(
        (F.col("id") / n).cast("int").alias("_s"), (F.col("id") % n).alias("_i")
    )
    cols = [value_map(F.col("_s"), dict(enumerate(states))).alias(STATE), _letter(F.col("_i")).alias(DISTRICT)]
    if with_location:
        cols.append(F.when(F.col("_i") % 2 == 0, F.lit(RURAL)).otherwise(F.lit(URBAN)).alias(LOCATION))
    for j, c in enumerate(columns):
        cols.append(value_map(F.col("_s"), {k: values[s][j] for k, s in enumerate(states)}).cast("int").alias(c))
    cols.append(F.lit(period).alias(PERIOD))
    return df.select(*cols)


def hygiene_fixture(spark: SparkSession, rows_per_state: int = 100) -> DataFrame:
    return constant_flags(spark, rows_per_state, HYGIENE_CONSTANTS, HYGIENE_CONSTANT_COLUMNS)


def sustain_fixture(spark: SparkSession, rows_per_state: int = 1000) -> DataFrame:
    return constant_flags(spark, rows_per_state, SUSTAIN_CONSTANTS, SUSTAIN_CONSTANT_COLUMNS,
                          with_location=False)


def medical_fixture(spark: SparkSession, rows_per_state: int = 2000, shares: dict | None = None,
                    unavailable: float = MEDICAL_UNAVAILABLE) -> DataFrame:
    """Rural/urban quota per state; the first ``int(n_loc * (1 - unavailable))``
    rows of each location have a medical check-up; complete check-up and
    total are always 1."""
    shares = shares or SPLIT_SHARES
    segs = []
    for state, by_loc in shares.items():
        for loc in (RURAL, URBAN):
            n_loc = int(rows_per_state * by_loc[loc])
            segs.append((state, loc, int(n_loc * (1 - unavailable)), n_loc))
    df = _segments(spark, segs)
    seg = F.col("_seg")
    have = value_map(seg, {k: s[2] for k, s in enumerate(segs)})
    return df.select(
        value_map(seg, {k: s[0] for k, s in enumerate(segs)}).alias(STATE),
        value_map(seg, {k: s[1] for k, s in enumerate(segs)}).alias(LOCATION),
        F.when(F.col("_i") < have, F.lit(1)).otherwise(F.lit(0)).alias("Medical_Checkup"),
        F.lit(1).alias("Complete_Medical_Checkup"),
        F.lit(1).alias(TOTAL),
    )
