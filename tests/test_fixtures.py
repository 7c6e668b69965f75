"""Reference-style validation: fixtures with hand-computed answers (FIXTURES.md)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from censuskit.operators import quality, ranking, rates, scores, segments
from censuskit.schema import DISTRICT, ESSENTIALS, LOCATION, MGMT_ID, STATE, TOTAL
from censuskit.sources import fixtures
from tests.conftest import rows


@pytest.fixture(scope="module")
def f1(spark):
    return fixtures.quota_split(spark).cache()


def test_f1_split_shares(spark, f1):
    totals = segments.split_ratio(segments.split_totals(f1, [STATE]))
    got = {r[STATE]: (r["Rural_School_Count"], r["Urban_School_Count"], r["Urban_Rural_Ratio"])
           for r in totals.collect()}
    assert got["A"][:2] == (40, 60) and got["B"][:2] == (70, 30) and got["C"][:2] == (80, 20)
    assert got["A"][2] == pytest.approx(1.5)
    assert got["B"][2] == pytest.approx(0.428571, abs=1e-6)
    assert got["C"][2] == pytest.approx(0.25)
    # Reference check Q1a, with a strict comparison of the shares.
    expected = spark.createDataFrame(
        [(s, loc, share) for s, d in fixtures.SPLIT_SHARES.items() for loc, share in d.items()],
        "State_Name string, Location string, share double",
    )
    observed = (
        f1.groupBy(STATE, LOCATION).agg(F.sum(TOTAL).alias("n"))
        .withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(STATE)))
    )
    checked = quality.compare(expected, observed, [STATE, LOCATION], "share", tol=1e-12)
    summary = quality.summarize(checked).collect()[0]
    assert (summary["Passed_Count"], summary["Failed_Count"]) == (6, 0)


def _rural(f1, private=False):
    cond = F.col(LOCATION) == "Rural"
    if private:
        cond = cond & (F.col(MGMT_ID) == 5)
    return f1.where(cond).groupBy(STATE, DISTRICT).agg(F.sum(TOTAL).alias("n"))


def test_f1_top_rural(f1):
    top = ranking.top_n(_rural(f1), [F.col("n").desc(), F.col(STATE), F.col(DISTRICT)], 10)
    got = [(r[STATE], r[DISTRICT], r["n"], r["Rank"]) for r in top.orderBy("Rank").collect()]
    assert got[:2] == [("C", "a", 4, 1), ("C", "b", 4, 2)]
    assert [(s, d, n) for s, d, n, _ in got[2:]] == [("B", c, 3) for c in "abcdefgh"]


def test_f1_rural_per_state_and_spread(f1):
    counts = _rural(f1)
    per = {(r[STATE], r[DISTRICT]): r["n"] for r in counts.collect()}
    assert all(per[("A", c)] == (2 if c <= "n" else 1) for c in "abcdefghijklmnopqrstuvwxyz")
    assert all(per[("B", c)] == (3 if c <= "r" else 2) for c in "abcdefghijklmnopqrstuvwxyz")
    assert all(per[("C", c)] == (4 if c <= "b" else 3) for c in "abcdefghijklmnopqrstuvwxyz")
    top = ranking.top_n(counts, [F.col("n").desc(), F.col(DISTRICT)], 10, by=[STATE])
    assert top.count() == 30
    spread = quality.spread_below(counts, [STATE], "n", limit=2)
    assert all(r["Passed"] and r["Spread"] == 1 for r in spread.collect())


def test_f1_private_rural(f1):
    priv = _rural(f1, private=True)
    got = rows(priv, STATE, DISTRICT, "n")
    expect = sorted([("A", d, 1) for d in "emv"] + [("B", d, 1) for d in "demv"] + [("C", d, 1) for d in "demuv"])
    assert got == expect
    top = ranking.top_n(priv, [F.col("n").desc(), F.col(STATE), F.col(DISTRICT)], 10)
    assert rows(top, STATE, DISTRICT) == sorted(
        [("A", "e"), ("A", "m"), ("A", "v"), ("B", "d"), ("B", "e"), ("B", "m"), ("B", "v"),
         ("C", "d"), ("C", "e"), ("C", "m")]
    )
    # Q1c check: every count equals 1.
    assert priv.where(F.col("n") != 1).count() == 0


def test_f1_mix_share(f1):
    share = segments.mix_share(segments.mix(f1, [LOCATION, MGMT_ID]), within=[LOCATION])
    tot = {r[LOCATION]: r["s"] for r in share.groupBy(LOCATION).agg(F.sum("Share_Pct").alias("s")).collect()}
    assert tot["Rural"] == pytest.approx(100.0) and tot["Urban"] == pytest.approx(100.0)
    labels = share.where(F.col("Share_Pct") <= 2).select("Label").distinct().collect()
    assert all(r["Label"] == "" for r in labels)


F2_EXPECTED = {
    "Functional_Drinking_Water": (40, 30, 19),
    "Functional_Boy_Toilet": (70, 60, 50),
    "Functional_Girl_Toilet": (80, 70, 60),
    "Handwash": (60, 50, 40),
    "Functional_Electricity": (70, 60, 50),
    "Functional_Newspaper": (30, 19, 9),
    "Library_or_Reading_Corner_or_Book_Bank": (44, 35, 25),
    "Playground": (80, 70, 60),
    "Internet": (15, 9, 5),
    "Computer_Available": (19, 15, 9),
}


def test_f2_quota_is_exact(spark):
    f2 = fixtures.quota_flags(spark)
    sums = f2.groupBy(STATE).agg(F.sum("Ramps").alias("r"), F.sum("Water_Purifier").alias("w"))
    assert rows(sums) == [("A", 1100.0, 2500.0), ("B", 900.0, 1500.0), ("C", 6500.0, 500.0)]


def test_f2_rates(spark):
    f2 = fixtures.quota_flags(spark)
    ess = rates.rate_gap_of_sums(f2, [STATE], {**ESSENTIALS, "Internet": "Internet",
                                               "Computer_Available": "Computer_Available"})
    got = {r[STATE]: r.asDict() for r in ess.collect()}
    for col, (a, b, c) in F2_EXPECTED.items():
        assert (got["A"][col], got["B"][col], got["C"][col]) == (a, b, c), col
    ramp = rates.rate_gap_of_rows(f2, [STATE], "Ramps", "ramp")
    order = [r[STATE] for r in ramp.orderBy(F.col("ramp").desc()).collect()]
    assert rows(ramp) == [("A", 10), ("B", 8), ("C", 65)] and order == ["C", "A", "B"]


def test_f3_hygiene(spark):
    f3 = fixtures.hygiene_fixture(spark)
    d = scores.district_score(scores.hygiene_rows(f3), [STATE, DISTRICT], name="h")
    st = {r[STATE]: r["h"] for r in scores.group_mean(d, [STATE], "h").collect()}
    assert st["A"] == pytest.approx(85, abs=1e-9)
    assert st["B"] == pytest.approx(80, abs=1e-9)
    assert st["C"] == pytest.approx(60, abs=1e-9)
    from censuskit.functions import round6

    above = ranking.above_group_mean(d, "h", compare=round6)
    assert above.count() == 52 and rows(above.select(STATE).distinct()) == [("A",), ("B",)]
    # D6: fewer than 10 rows is fine.
    small = scores.district_score(scores.hygiene_rows(fixtures.hygiene_fixture(spark, 2)), [STATE, DISTRICT], name="h")
    assert ranking.top_n(small, [F.col("h").desc(), F.col(STATE), F.col(DISTRICT)], 10).count() == 6


def test_f4_sustainability(spark):
    f4 = fixtures.sustain_fixture(spark)
    d = scores.district_score(scores.sustainability_rows(f4), [STATE, DISTRICT], name="s", scale=100)
    st = {r[STATE]: r["s"] for r in scores.group_mean(d, [STATE], "s").collect()}
    assert st["A"] == pytest.approx(100, abs=1e-9)
    assert st["B"] == pytest.approx(70, abs=1e-9)
    assert st["C"] == pytest.approx(60, abs=1e-9)


def test_f5_medical(spark):
    f5 = fixtures.medical_fixture(spark)
    have = f5.groupBy(STATE, LOCATION).agg(F.sum("Medical_Checkup").alias("m"), F.count("*").alias("n"))
    assert rows(have) == [("A", "Rural", 240, 800), ("A", "Urban", 360, 1200), ("B", "Rural", 420, 1400),
                          ("B", "Urban", 180, 600), ("C", "Rural", 480, 1600), ("C", "Urban", 120, 400)]
    lack = rates.lack_rate(f5, [STATE], "Medical_Checkup", "lack")
    has = rates.have_rate(f5, [STATE], "Medical_Checkup", "have")
    comp = rates.have_rate(f5, [LOCATION], "Complete_Medical_Checkup", "c")
    assert {r["lack"] for r in lack.collect()} == {70}
    assert {r["have"] for r in has.collect()} == {30}
    assert {r["c"] for r in comp.collect()} == {100}


def test_sector_fixture(spark):
    data = [(mid, 1, 1 if mid in (5, 3, 1) else 0, 0, 0, 0) for mid in (5, 4, 3, 97, 98, 1, 92)]
    df = spark.createDataFrame(
        [("A",) + r for r in data],
        "State_Name string, School_Management_Id int, Total_Number_of_Schools int, Solar_Panel int, "
        "Kitchen_Garden int, Rain_Water_Harvesting int, Incinerator int",
    )
    out = segments.sector_compare(scores.sustainability_rows(df), scores.ROW_SCORE, [STATE]).collect()[0]
    assert out["Private_Score"] == pytest.approx(20)
    assert out["Aided_Score"] == pytest.approx(0)
    assert out["Others_Score"] == pytest.approx(20 / 3)
    assert out["Government_Score"] == pytest.approx(10)
