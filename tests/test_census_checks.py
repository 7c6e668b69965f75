"""Ordered aliases as a table, state-qualified joins, quartiles by rank, checks
from a tolerance table, malformed results cells, null policies."""

import os
import random
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from censuskit.operators import correlate, distribution, normalize, quality
from censuskit.operators.normalize import apply_aliases
from censuskit.plans import QUERIES, catalog, oracle_sql, study
from censuskit.schema import DISTRICT, PERIOD, STATE
from censuskit.sources.outcome import bad_outcome_values, outcome_long, read_outcome_csv
from tests.conftest import SF01, rows


def test_ordered_alias_table_folds_like_the_list(spark, monkeypatch):
    pairs = [("bagalkot", "bagalkote"), ("e", "3"), ("kot3", "fort "), ("", "x"), ("none", "")]
    names = spark.createDataFrame([("bagalkot",), ("bagalkote",), ("",), (None,), ("one none",)], "n string")
    table = spark.createDataFrame([(i, *p) for i, p in reversed(list(enumerate(pairs)))] + [(9, None, "y"), (9, "y", None)], "alias_order int, alias_from string, alias_to string")
    got = apply_aliases(names, "n", table, mode="substring", out="m").collect()
    assert {r.n: r.m for r in got} == {r.n: r.m for r in apply_aliases(names, "n", pairs, mode="substring", out="m").collect()}
    assert {r.n: r.m for r in got}["bagalkote"] == "bagalfort 3"
    assert {r.n for r in apply_aliases(names, "n", table.limit(0), mode="substring").collect()} == {r.n for r in names.collect()}
    with pytest.raises(ValueError):
        apply_aliases(names, "n", table.drop("alias_order"), mode="substring")
    monkeypatch.setattr(normalize, "MOST_ALIASES", 3)
    with pytest.raises(ValueError):
        apply_aliases(names, "n", table, mode="substring")


def test_equal_district_names_never_meet_another_state(spark):
    features = spark.createDataFrame([("2017_2018", "A", "x", 1), ("2017_2018", "B", "x", 2), ("2018_2019", "A", "y", 3)], f"{PERIOD} string, {STATE} string, k string, f int")
    results = spark.createDataFrame([("A", "x", "2017", 10.0), ("B", "x", "2017", 20.0), ("A", "y", "2018", 30.0)], f"{STATE} string, k string, Exam_Year string, p double")
    join = lambda f, r, state: correlate.join_outcome(f, r, "k", "k", PERIOD, "Exam_Year", state=state)
    assert rows(join(features, results, STATE), STATE, "k", "f", "p") == [("A", "x", 1, 10.0), ("A", "y", 3, 30.0), ("B", "x", 2, 20.0)]
    with pytest.raises(Exception, match="district name in several states: x"):
        join(features, results.drop(STATE), STATE).collect()
    # One name in one state a year is no clash.
    once = features.where("f != 2")
    assert rows(join(once, results.drop(STATE).where("p != 20"), STATE), STATE, "k", "f", "p") == [("A", "x", 1, 10.0), ("A", "y", 3, 30.0)]


def test_study_refuses_shared_names_without_a_state(spark):
    from censuskit.plans import catalog

    census = catalog.statistics(spark, SF01).withColumn(DISTRICT, F.lit("Nation 1"))
    with pytest.raises(Exception, match="district name in several states"):
        study.corr(census, catalog.outcome(spark, SF01)).collect()


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_quantiles_by_rank_equal_percentiles(spark, buckets, monkeypatch):
    rng = random.Random(buckets)
    data = [("hot", rng.choice([0.0, 0.0, 1.5, rng.gauss(0, 100)])) for _ in range(3000)] + [("one", 5.0), ("same", 2.0), ("same", 2.0), ("two", -1e300), ("two", 1e300)]
    data += [("wide", 10.0**rng.randint(-200, 200)) for _ in range(57)] + [("none", None), ("hot", None), ("odd", float("nan")), ("odd", 3.0), ("odd", float("inf"))]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.77, 1.0]
    for bound in (distribution.BROADCAST_GROUPS, 0):
        monkeypatch.setattr(distribution, "BROADCAST_GROUPS", bound)
        got = {r.g: list(r["_q"]) for r in distribution.quantiles_by_rank(df, ["g"], "v", probs, buckets).collect()}
    finite = df.where("v is not null and not isnan(v) and abs(v) < double('inf')")
    want = {r.g: r.q for r in finite.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect()}
    assert got.keys() == want.keys() == {"hot", "one", "same", "two", "wide", "odd"}
    for g in got:
        assert got[g] == pytest.approx(want[g], rel=1e-12), g


def test_box_by_rank_equals_box(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.choice("ab"), rng.gauss(0, 1) ** 3) for _ in range(500)], "g string, v double")
    a, b = ({r.g: r.asDict() for r in distribution.box_stats(df, ["g"], "v", by_rank=x).collect()} for x in (False, True))
    assert a.keys() == b.keys() and all(a[g][c] == pytest.approx(b[g][c]) for g in a for c in a[g] if c != "g")
    assert all(a[g]["Median"] == pytest.approx(statistics.median(r.v for r in df.collect() if r.g == g)) for g in a)


def test_hot_group_is_aggregated_before_any_shuffle(spark):
    df = spark.createDataFrame([("g", float(i)) for i in range(100)], "g string, v double")
    plan = distribution.quantiles_by_rank(df, ["g"], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "percentile" not in plan


def test_checks_by_measure(spark):
    observed = spark.createDataFrame([("a", 1, 5), ("b", 2, None), ("c", 3, 7)], "k string, x int, y int")
    expected = spark.createDataFrame([("a", "x", 2.0, 1.0), ("a", "y", 2.0, 1.0), ("b", "x", 2.0, 0.0), ("b", "y", 2.0, 9.0), ("c", "x", 3.0, None), ("d", "x", 1.0, 1.0)],
                                     f"k string, {quality.MEASURE} string, Expected double, Tolerance double")
    got = {(r.k, r[quality.MEASURE]): (r.Observed, r.Abs_Diff, r.Passed) for r in quality.compare_measures(observed, expected, ["k"], ["x", "y"]).collect()}
    assert got == {("a", "x"): (1.0, 1.0, True), ("a", "y"): (5.0, 3.0, False), ("b", "x"): (2.0, 0.0, True), ("b", "y"): (None, None, False),
                   ("c", "x"): (3.0, 0.0, False), ("c", "y"): (7.0, None, False), ("d", "x"): (None, None, False)}


def test_malformed_results_cells_are_told(spark, tmp_path):
    path = os.path.join(tmp_path, "sheet.csv")
    with open(path, "w") as f:
        f.write("Districts1,2017,Districts2,2018\nA,70.5,B,n/a\nB, 12 ,A,\nC,absent,,\n,,C,1e1\n")
    sheet = read_outcome_csv(spark, path, line="Line")
    assert rows(bad_outcome_values(sheet, "Line"), "Exam_Year", "Line", DISTRICT, "Raw_Value") == [("2017", 2, "C", "absent"), ("2018", 0, "B", "n/a")]
    long = outcome_long(sheet.drop("Line"))
    assert {(r[0], r[1]): r[2] for r in long.collect()} == {("a", "2017"): 70.5, ("b", "2017"): 12.0, ("c", "2017"): None, ("b", "2018"): None, ("a", "2018"): None, ("c", "2018"): 10.0}


def test_complete_lists_are_of_all_orders(spark, tmp_path):
    """Districts are complete by orders of any priority and segment, and their means are of all of them."""
    d = str(tmp_path)
    orders = [(1, 1000.0 * y, "5-LOW" if y % 2 else "1-URGENT", y) for y in catalog.ORDER_YEARS] + [(2, 9000.0, "3-MEDIUM", y) for y in catalog.ORDER_YEARS]
    orders += [(3, 500_000.0, "1-URGENT", y) for y in list(catalog.ORDER_YEARS)[1:]]  # nothing in the first year
    spark.createDataFrame(orders, "o_custkey long, o_totalprice double, o_orderpriority string, y int").selectExpr(
        "o_custkey", "o_totalprice", "o_orderpriority", "make_date(y, 6, 1) as o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1, 1, "BUILDING"), (2, 1, "AUTOMOBILE"), (3, 2, "AUTOMOBILE")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(1, "NATION_1"), (2, "NATION_2")], "n_nationkey int, n_name string").write.parquet(f"{d}/nation.parquet")
    got = rows(QUERIES["outcome_complete"](spark, d), DISTRICT, "Exam_Year", "Pass_Pct")
    assert got == [("nation 1", e, round((1000.0 * y + 9000.0) / 2 / 5000, 6)) for y, e in zip(catalog.ORDER_YEARS, catalog.EXAM_YEARS)]
    db = duckdb.connect()
    for t in ("orders", "customer", "nation"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    assert sorted(db.execute(oracle_sql()["outcome_complete"]).fetchall()) == got


def test_queries_show_what_they_are_named_for(spark):
    run = lambda n: QUERIES[n](spark, SF01).collect()
    complete = run("outcome_complete")
    assert len({r.District_Name for r in complete}) == 25 and len(complete) == 7 * len({r.District_Name for r in complete})
    assert all(r.Passed_Count + r.Failed_Count == 5 for r in run("quality_tolerance_counts"))
    by_year = {}
    for r in run("quality_tolerances"):
        by_year.setdefault(r[PERIOD], set()).add(r.Passed)
    assert len(by_year) == 7 and all(v == {True, False} for v in by_year.values())
    a, b = ({(r[PERIOD], r[STATE]): r.Ramp_Access_Pct for r in run(n)} for n in ("ramp", "ramp_zero"))
    assert a.keys() == b.keys() and any(a[k] != b[k] for k in a)
    spelled = run("state_spelling")
    assert any(r.Schools_After is None for r in spelled) and any(r.Schools_Before and r.Schools_After and r.Schools_After > r.Schools_Before for r in spelled)
    assert sum(r.Schools_Before for r in spelled) == sum(r.Schools_After or 0 for r in spelled)
    assert {r.District_Key.split(" ")[0] for r in run("aliases_in_order")} & {"asia", "africa"}
    assert run("outcome_bad") and all(r.Raw_Value.startswith("below") for r in run("outcome_bad"))
    assert sum(r.N for r in run("box_rows")) > 40_000
    assert rows(QUERIES["corr_by_state"](spark, SF01)) == rows(QUERIES["corr"](spark, SF01))  # the same districts under other names
