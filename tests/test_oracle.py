"""Correctness gate: every registered query against its DuckDB oracle at sf0.01."""

import math

import pytest

import __spark_entry__ as E
from censuskit import plans
from scripts.check_oracle import compare, duck
from tests.conftest import SF01

# The library's own queries; those of an optional subpackage have tests there.
QUERIES = plans.QUERIES
ORACLE = plans.oracle_sql()


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _, n = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert not problems, problems
    assert n > 0


def test_no_line_item_is_lost(spark):
    """Every line item becomes a census row; every order counts in the outcome."""
    from censuskit.plans import catalog
    from censuskit.schema import TOTAL

    lines = spark.read.parquet(f"{SF01}/lineitem.parquet")
    census = catalog.census(spark, SF01)
    assert census.count() == lines.count() == 60_000
    assert census.agg({TOTAL: "sum"}).first()[0] == lines.where("l_orderkey % 97 != 0").selectExpr("sum(int(l_quantity))").first()[0]
    assert sorted(r[0] for r in census.select("Academic_Year").distinct().collect()) == catalog.PERIODS
    years = {r[0] for r in catalog.outcome(spark, SF01).select("Exam_Year").distinct().collect()}
    assert years == set(catalog.EXAM_YEARS)


def test_checks_see_both_outcomes(spark):
    """The queries exercise what they are named for."""
    run = lambda n: QUERIES[n](spark, SF01).collect()
    assert {r.Rank for r in run("top_rural_per_state")} == {1, 2, 3}
    assert {r.Label == "" for r in run("state_mgmt_share")} == {True, False}
    assert {r.Passed for r in run("quality_expected")} == {True, False}
    assert all(r.Passed_Count and r.Failed_Count for r in run("quality_expected_counts"))
    assert {r.Passed for r in run("quality_spread")} == {True, False}
    assert {r.Check_Name: r.Unexpected > 0 for r in run("quality_unique")} == {"orders": False, "lineitem": True}
    whole, complete = run("outcome_long"), run("outcome_complete")
    assert len(complete) == len(whole) == 175 and {tuple(r) for r in complete} == {tuple(r) for r in whole}  # every district has orders in every year


def test_entry_smoke(spark):
    df = E.entry(spark)
    got = df.collect()
    assert len(got) > 0
    assert df.columns == ["Academic_Year", "State_Name", "District_Name", "Sustainability_Score", "Rank"]
    assert all(not math.isnan(r["Sustainability_Score"]) for r in got)
