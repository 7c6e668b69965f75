"""Outcome table (district exam pass percentages).

The study's results sheet holds independently sorted (district, pass %)
lists side by side, one pair of columns per exam year. ``read_outcome_csv``
reads such a sheet; ``outcome_sheet`` builds the same layout from the driver
tables; ``outcome_long`` turns either into one row per (district, year).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from censuskit.operators.normalize import stack_lists
from censuskit.schema import DISTRICT
from censuskit.sources import storage
from censuskit.operators.trends import listed, periods_of
from censuskit.sources.census import YEAR_OFFSET

EXAM_YEAR = "Exam_Year"
PASS_PCT = "Pass_Pct"

OUTCOME_VERSION = "2"
# Scale of the pass percentage derived from order prices.
PRICE_PER_PASS_POINT = 5000.0


def read_outcome_csv(spark: SparkSession, path: str, line: str | None = None) -> DataFrame:
    """Read a results sheet as strings; values are cast in ``stack_lists``.
    ``line`` names a column that numbers the rows up from 0 (without gaps in a
    sheet of one split)."""
    sheet = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return sheet.withColumn(line, F.monotonically_increasing_id()) if line else sheet


def outcome_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(district, exam year, pass %) derived from the driver tables: the mean
    order price of a nation's customers in a year, scaled to a percentage.
    A district without orders in a year is not listed."""
    d = sf_dir.rstrip("/")
    orders = storage.read_table(spark, f"{d}/orders.parquet").select(
        "o_custkey", "o_totalprice", F.year("o_orderdate").alias("_y")
    )
    customer = storage.read_table(spark, f"{d}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = storage.read_table(spark, f"{d}/nation.parquet").select("n_nationkey", "n_name")
    # Pre-aggregate orders to (customer, year) sums and counts before the
    # customer join (map-side partial aggregation absorbs a hot customer), so
    # the join moves one row per customer and year instead of every order;
    # then combine to (nation, year) and only then attach the nation names.
    per_customer = orders.groupBy("o_custkey", "_y").agg(
        F.sum("o_totalprice").alias("_sum"), F.count("o_totalprice").alias("_n")
    )
    per_nation = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "_y")
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("_avg_price"))
    )
    return per_nation.join(F.broadcast(nation), per_nation.c_nationkey == nation.n_nationkey).select(
        F.regexp_replace("n_name", "NATION_", "Nation ").alias(DISTRICT),
        (F.col("_y") + YEAR_OFFSET).cast("string").alias(EXAM_YEAR),
        F.round(F.col("_avg_price") / F.lit(PRICE_PER_PASS_POINT), 6).alias(PASS_PCT),
    )


def outcome_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``outcome_by_district`` materialised once per session (it feeds every
    correlation query)."""
    d = sf_dir.rstrip("/")
    return storage.materialize(
        spark,
        "outcome",
        [f"{d}/{t}.parquet" for t in ("orders", "customer", "nation")],
        OUTCOME_VERSION,
        build=lambda: outcome_by_district(spark, d),
        write=lambda df, path: df.write.mode("overwrite").parquet(path),
        read=lambda path: spark.read.parquet(path),
    )


def outcome_sheet(spark: SparkSession, sf_dir: str, long: DataFrame | None = None, years=None, line: str | None = None) -> DataFrame:
    """The results-sheet layout: for each exam year a pair of columns
    (``Districts1``, the year's name, ...) with the list of (district, pass %)
    sorted by district, the lists placed side by side by position.

    ``years`` defaults to those that occur; a year outside a given list is an
    error. ``line`` names a column that keeps the position. The window is partitioned by year over per-district rows, so each
    window group is bounded by the number of districts, not by the data size.
    """
    if long is None:
        long = outcome_by_district(spark, sf_dir)
    years = list(years or periods_of(long, EXAM_YEAR))
    long = long.withColumn(EXAM_YEAR, listed(EXAM_YEAR, years))
    pos = F.row_number().over(Window.partitionBy(EXAM_YEAR).orderBy(DISTRICT, PASS_PCT))
    ranked = long.withColumn("_pos", pos)
    aggs = []
    for i, year in enumerate(years):
        hit = F.col(EXAM_YEAR) == F.lit(year)
        aggs.append(F.max(F.when(hit, F.col(DISTRICT))).alias(f"Districts{i + 1}"))
        aggs.append(F.max(F.when(hit, F.col(PASS_PCT))).alias(year))
    sheet = ranked.groupBy("_pos").agg(*aggs)
    return sheet.withColumnRenamed("_pos", line) if line else sheet.drop("_pos")


def bad_outcome_values(sheet: DataFrame, line: str, pairs=None) -> DataFrame:
    """The cells of a results sheet that hold a value which is no number, and so
    are null in ``outcome_long``: ``Exam_Year`` (the list), ``line``,
    ``District_Name`` as written and ``Raw_Value``. Empty cells are not bad."""
    names = [c for c in sheet.columns if c != line]
    pairs = pairs or [(n, v, v) for n, v in zip(names[0::2], names[1::2])]
    cells = [F.struct(F.lit(str(label)).alias(EXAM_YEAR), F.col(f"`{n}`").alias(DISTRICT), F.col(f"`{v}`").cast("string").alias("Raw_Value")) for n, v, label in pairs]
    long = sheet.select(F.col(line), F.explode(F.array(*cells)).alias("_cell")).select(f"_cell.{EXAM_YEAR}", line, f"_cell.{DISTRICT}", "_cell.Raw_Value")
    raw = F.trim("Raw_Value")
    return long.where((raw != "") & raw.try_cast("double").isNull())


def outcome_long(sheet: DataFrame, pairs=None, complete_only: bool = False, aliases=None) -> DataFrame:
    """One row per (district, exam year) from a results sheet; district names
    are lower-cased, values cast to double (a malformed value becomes null).
    ``pairs`` (name column, value column, label) default to the sheet's columns
    two by two, the value column naming the year. ``aliases`` mend spellings in
    every list first; ``complete_only`` then keeps districts listed in every
    year, as the study's inner join of the mended yearly lists did."""
    names = sheet.columns
    pairs = pairs or [(n, v, v) for n, v in zip(names[0::2], names[1::2])]
    return stack_lists(sheet, pairs, name_out=DISTRICT, label_out=EXAM_YEAR, value_out=PASS_PCT,
                       complete_only=complete_only, aliases=aliases)
