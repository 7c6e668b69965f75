"""Property tests: operators against a plain-Python brute force on random
small censuses (nulls and zero totals included)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from censuskit.operators import ranking, rates, scores
from censuskit.schema import HYGIENE_WEIGHTS, SUSTAINABILITY_WEIGHTS

SCHEMA = ("s string, d string, t int, Ramps int, Solar_Panel int, Kitchen_Garden int, "
          "Rain_Water_Harvesting int, Incinerator int, Functional_Drinking_Water int, Water_Purifier int, "
          "Functional_Toilet_Facility int, Handwash int, Functional_Urinal int, Water_Tested int")
MEASURE_COLS = SCHEMA.split(", ")[3:]


@st.composite
def census_rows(draw):
    n = draw(st.integers(1, 25))
    out = []
    for _ in range(n):
        t = draw(st.integers(0, 30))
        vals = [draw(st.one_of(st.none(), st.integers(0, t))) for _ in MEASURE_COLS]
        out.append((draw(st.sampled_from("AB")), draw(st.sampled_from("xyz")), t, *vals))
    return out


SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _groups(data, key):
    g = {}
    for r in data:
        g.setdefault(key(r), []).append(r)
    return g


@SETTINGS
@given(data=census_rows())
def test_rate_forms(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got_rows = {r["s"]: r["p"] for r in rates.rate_gap_of_rows(df, ["s"], "Ramps", "p", total="t").collect()}
    got_sums = {r["s"]: r["p"] for r in rates.rate_gap_of_sums(df, ["s"], {"p": "Ramps"}, total="t").collect()}
    for s, rs in _groups(data, lambda r: r[0]).items():
        tot = sum(r[2] for r in rs)
        gaps = [r[2] - r[3] for r in rs if r[3] is not None]
        ramps = [r[3] for r in rs if r[3] is not None]
        exp_rows = None if tot == 0 or not gaps else int(100 * (1 - sum(gaps) / tot))
        exp_sums = None if tot == 0 or not ramps else int(100 * (1 - (tot - sum(ramps)) / tot))
        assert got_rows[s] == exp_rows
        assert got_sums[s] == exp_sums


def _mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


@SETTINGS
@given(data=census_rows())
def test_scores_and_top_n(spark, data):
    df = spark.createDataFrame(data, SCHEMA).withColumnRenamed("t", "Total_Number_of_Schools")
    idx = {c.split()[0]: i + 3 for i, c in enumerate(MEASURE_COLS)}

    def sustain(r):
        if r[2] == 0 or any(r[idx[m]] is None for m, _ in SUSTAINABILITY_WEIGHTS):
            return None
        return sum(r[idx[m]] / r[2] * w for m, w in SUSTAINABILITY_WEIGHTS)

    def hygiene(r):
        if r[2] == 0 or any(r[idx[m]] is None for m, _ in HYGIENE_WEIGHTS):
            return None
        return 100 * sum(r[idx[m]] * w for m, w in HYGIENE_WEIGHTS) / r[2]

    for rowfn, fn, scale in ((scores.sustainability_rows, sustain, 100), (scores.hygiene_rows, hygiene, None)):
        got = {(r["s"], r["d"]): r["v"] for r in
               scores.district_score(rowfn(df), ["s", "d"], name="v", scale=scale).collect()}
        for k, rs in _groups(data, lambda r: (r[0], r[1])).items():
            exp = _mean([fn(r) for r in rs])
            if exp is not None and scale:
                exp *= scale
            if exp is None:
                assert got[k] is None
            else:
                assert math.isclose(got[k], exp, rel_tol=1e-9, abs_tol=1e-9)

    counts = df.groupBy("s", "d").agg(F.sum("Total_Number_of_Schools").alias("n"))
    top = ranking.top_n(counts, [F.col("n").desc(), F.col("s"), F.col("d")], 3)
    exp = sorted(((k[0], k[1], sum(r[2] for r in rs)) for k, rs in _groups(data, lambda r: (r[0], r[1])).items()),
                 key=lambda x: (-x[2], x[0], x[1]))[:3]
    assert [(r["s"], r["d"], r["n"]) for r in top.orderBy("Rank").collect()] == exp
