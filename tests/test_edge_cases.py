"""Edge cases of SURVEY §1.4 (FIXTURES.md F6)."""

import pytest
from pyspark.sql import functions as F

from censuskit.functions import pct_gap_of_sums, pct_have, pearson
from censuskit.operators import correlate, normalize, rates, scores, segments, trends
from censuskit.schema import STATE, TOTAL
from tests.conftest import rows


def test_d2_null_measure_rate_forms(spark):
    df = spark.createDataFrame([("A", 10, 4), ("A", 10, None)], "State_Name string, Total_Number_of_Schools int, Ramps int")
    assert rows(rates.rate_gap_of_rows(df, [STATE], "Ramps", "p")) == [("A", 70)]
    assert rows(rates.rate_gap_of_sums(df, [STATE], {"p": "Ramps"})) == [("A", 19)]


def test_d3_truncation_forms(spark):
    df = spark.createDataFrame([(100, f) for f in (7, 20, 29, 45)], "t int, f int")
    got = df.select("f", pct_gap_of_sums("t", "f").alias("gap"), pct_have("t", "f").alias("have"))
    assert rows(got) == [(7, 6, 7), (20, 19, 20), (29, 29, 28), (45, 44, 45)]


def test_d5_zero_total(spark):
    df = spark.createDataFrame(
        [("A", "d", 0, 1, 1, 1, 1), ("A", "d", 1, 1, 0, 0, 0)],
        "State_Name string, District_Name string, Total_Number_of_Schools int, Solar_Panel int, "
        "Kitchen_Garden int, Rain_Water_Harvesting int, Incinerator int",
    )
    scored = scores.sustainability_rows(df, name="s")
    assert [r["s"] for r in scored.orderBy(TOTAL).collect()][0] is None
    d = scores.district_score(scored, [STATE, "District_Name"], score="s", name="v", scale=100)
    assert d.collect()[0]["v"] == pytest.approx(20)


def test_d9_missing_sector(spark):
    df = spark.createDataFrame(
        [("A", 5, 1, 1, 0, 0, 0), ("A", 1, 1, 0, 0, 0, 0), ("A", 3, 1, 0, 0, 0, 0)],
        "State_Name string, School_Management_Id int, Total_Number_of_Schools int, Solar_Panel int, "
        "Kitchen_Garden int, Rain_Water_Harvesting int, Incinerator int",
    )
    scored = scores.sustainability_rows(df)
    out = segments.sector_compare(scored, scores.ROW_SCORE, [STATE]).collect()[0]
    assert out["Aided_Score"] is None and out["Private_Score"] == pytest.approx(20)
    assert segments.sector_compare(scored, scores.ROW_SCORE, [STATE], require_all=True).count() == 0


def test_d10_missing_side(spark):
    df = spark.createDataFrame([("A", "Rural", 5)], "State_Name string, Location string, Total_Number_of_Schools int")
    r = segments.split_ratio(segments.split_totals(df, [STATE])).collect()[0]
    assert r["Rural_School_Count"] == 5 and r["Urban_School_Count"] is None and r["Urban_Rural_Ratio"] is None


def test_d11_alias_modes(spark):
    df = spark.createDataFrame([("bagalkote",), ("chikodi",)], "d string")
    pairs = [("bagalkot", "bagalkote")]
    assert rows(normalize.apply_aliases(df, "d", pairs)) == [("bagalkote",), ("chikodi",)]
    assert rows(normalize.apply_aliases(df, "d", pairs, mode="substring")) == [("bagalkotee",), ("chikodi",)]
    table = spark.createDataFrame([("chikodi", "belagavi chikkodi")], "alias_from string, alias_to string")
    assert rows(normalize.apply_aliases(df, "d", table)) == [("bagalkote",), ("belagavi chikkodi",)]


def test_d12_correlation_null_pairs_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, None), (4.0, 9.0), (None, 5.0)], "x double, y double")
    assert df.select(pearson("x", "y")).collect()[0][0] == pytest.approx(0.979864, abs=1e-6)
    zero = df.na.fill(0.0)
    assert zero.select(pearson("x", "y")).collect()[0][0] == pytest.approx(0.277350, abs=1e-6)
    grouped = df.withColumn("g", F.lit(1))
    skip = correlate.feature_correlations(grouped, ["g"], ["x"], "y").collect()[0]["Correlation"]
    zero = correlate.feature_correlations(grouped, ["g"], ["x"], "y", null_policy="zero").collect()[0]
    assert skip == pytest.approx(0.979864, abs=1e-6)
    assert zero["Correlation"] == pytest.approx(0.277350, abs=1e-6)
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert const.select(pearson("x", "y")).collect()[0][0] is None
    fit = correlate.fit_line(const.withColumn("g", F.lit(1)), ["g"], "x", "y").collect()[0]
    assert fit["Slope"] is None


def test_d13_extremes_tie_rule(spark):
    corr = spark.createDataFrame(
        [("y1", "a", 0.5), ("y1", "b", 0.9), ("y2", "a", 0.9), ("y2", "b", -0.2), ("y1", "c", -0.2), ("y2", "c", None)],
        "Academic_Year string, Feature string, Correlation double",
    )
    r = correlate.extremes(corr, ["a", "b", "c"], "Academic_Year").collect()[0]
    assert (r["Max_Feature"], r["Max_Academic_Year"]) == ("b", "y1")
    assert (r["Min_Feature"], r["Min_Academic_Year"]) == ("c", "y1")


def test_d16_incomplete_period(spark):
    df = spark.createDataFrame(
        [("A", "p1", 1), ("A", "p2", 2), ("B", "p1", 3)], "State_Name string, Academic_Year string, v int"
    )
    wide = trends.wide_by_period(df, [STATE], "Academic_Year", "v", ["p1", "p2"])
    assert rows(wide) == [("A", 1, 2)]
    keep = trends.wide_by_period(df, [STATE], "Academic_Year", "v", ["p1", "p2"], complete_only=False)
    assert rows(keep) == [("A", 1, 2), ("B", 3, None)]
    assert trends.wide_by_period(df, [STATE], "Academic_Year", "v").columns == [STATE, "p1", "p2"]
    with pytest.raises(Exception, match="period not listed: p2"):
        trends.wide_by_period(df, [STATE], "Academic_Year", "v", ["p1"]).collect()


def test_state_spelling_is_mended_before_aggregation(spark):
    from censuskit.plans import study

    df = spark.createDataFrame([("Kerla", "Rural", 5), ("Kerala", "Urban", 7), ("Kerala", "Rural", 1)], "State_Name string, Location string, Total_Number_of_Schools int")
    out = study.split(study.prepare(df.withColumn("Academic_Year", F.lit("y")))).collect()
    assert [(r["State_Name"], r["Rural_School_Count"], r["Urban_School_Count"]) for r in out] == [("Kerala", 6, 7)]


def test_aliases_come_before_completeness(spark):
    from censuskit.operators.normalize import EXAM_DISTRICT_ALIASES
    from censuskit.sources import outcome

    sheet = spark.createDataFrame([("Bagalkote", "70", "Bagalkot", "71", "Bagalkote", "72"), ("Bidar", "1", "Bidar", "2", None, None)], "a string, `2017` string, b string, `2018` string, c string, `2019` string")
    long = outcome.outcome_long(sheet, complete_only=True, aliases=EXAM_DISTRICT_ALIASES)
    assert rows(long) == [("bagalkot", "2017", 70.0), ("bagalkot", "2018", 71.0), ("bagalkot", "2019", 72.0)]
    assert long._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0


def test_counts_that_are_not_as_expected(spark):
    from censuskit.operators import quality

    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "b"), ("h", "c")], "g string, k string")
    assert rows(quality.count_unexpected(df, ["k"], by=["g"])) == [("g", 2, 1), ("h", 1, 0)]
    assert rows(quality.count_unexpected(df, ["k"])) == [(3, 1)]


def test_stack_lists_and_csv_sheet(spark, tmp_path):
    path = tmp_path / "results.csv"
    path.write_text("Districts1,2017,Districts2,2018,Districts3,2019\n"
                    "Bagalkot,70.5,Bagalkot,71.0,Bidar,60\n"
                    "Bidar,55.25,Bidar,n/a,,\n")
    from censuskit.sources import outcome

    sheet = outcome.read_outcome_csv(spark, str(path))
    long = outcome.outcome_long(sheet)
    got = rows(long, "District_Name", "Exam_Year", "Pass_Pct")
    assert got == [("bagalkot", "2017", 70.5), ("bagalkot", "2018", 71.0), ("bidar", "2017", 55.25),
                   ("bidar", "2018", None), ("bidar", "2019", 60.0)]
    # The study joined the yearly lists inner: bagalkot lacks 2019.
    complete = rows(outcome.outcome_long(sheet, complete_only=True), "District_Name", "Exam_Year")
    assert complete == [("bidar", "2017"), ("bidar", "2018"), ("bidar", "2019")]


def test_box_stats_exact_and_approx(spark):
    from censuskit.operators import distribution

    vals = [("g", float(v)) for v in (1, 2, 3, 4, 100)]
    df = spark.createDataFrame(vals, "g string, v double")
    exact = distribution.box_stats(df, ["g"], "v").collect()[0]
    assert (exact["Q1"], exact["Median"], exact["Q3"]) == (2.0, 3.0, 4.0)
    assert (exact["Lower_Fence"], exact["Upper_Fence"]) == (-1.0, 7.0)
    assert (exact["Whisker_Low"], exact["Whisker_High"], exact["Outliers"]) == (1.0, 4.0, 1)
    approx = distribution.box_stats(df, ["g"], "v", approx=True).collect()[0]
    assert approx["Median"] == 3.0 and approx["Outliers"] == 1


def test_outcome_sheet_round_trip(spark):
    from tests.conftest import SF001
    from censuskit.sources import outcome

    sheet = outcome.outcome_sheet(spark, SF001)
    years = [str(y) for y in range(2017, 2024)]
    assert sheet.columns == [c for i, y in enumerate(years) for c in (f"Districts{i + 1}", y)]
    got = sheet.collect()
    for name_col, year in zip(sheet.columns[0::2], sheet.columns[1::2]):
        names = sorted(r[name_col] for r in got if r[name_col] is not None)
        expect = sorted(r["District_Name"] for r in outcome.outcome_by_district(spark, SF001)
                        .where(F.col("Exam_Year") == year).collect())
        assert names == expect
    long = outcome.outcome_long(sheet)
    direct = outcome.outcome_by_district(spark, SF001).select(
        F.lower("District_Name").alias("District_Name"), "Exam_Year", "Pass_Pct")
    assert rows(long) == rows(direct)
