"""The study's analyses as functions of a census DataFrame.

Every function takes the census (any DataFrame with the census columns it
uses: from ``read_census_csv``, ``read_census`` or ``derived_census``) or its
``rollup``, one scan that serves them all, and,
for the correlation part, the long outcome table (``District_Name``,
``Exam_Year``, ``Pass_Pct``) and returns a DataFrame. All years are handled
in one run (``Academic_Year`` is a grouping key); top-n lists are per year.
Averaged doubles are rounded to 6 places and rankings use the rounded value
followed by fixed name tie keys.

District names of the census and of the outcome meet on a key:
``lower(trim(name))`` of both sides, with ``census_aliases`` applied to the
census key and ``outcome_aliases`` to the outcome key (lists of pairs or
DataFrames ``alias_from``/``alias_to``; exact whole-value matches). An outcome
with ``State_Name`` is met by state, too; without it, a district name that
stands in several states is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from censuskit.functions import pct_gap_of_sums, round6
from censuskit.operators import correlate, distribution, quality, ranking, rates, rollup, scores, segments, trends
from censuskit.operators.normalize import apply_aliases, normalize_key
from censuskit.schema import (
    ADVANCED,
    DISTRICT,
    DISTRICT_FEATURES,
    ESSENTIALS,
    LOCATION,
    MGMT_ID,
    PERIOD,
    PRIVATE_UNAIDED_ID,
    RURAL,
    STATE,
    STATE_ALIASES,
    TOTAL,
)

YS = [PERIOD, STATE]
YSD = [PERIOD, STATE, DISTRICT]
TOP_N = 10

SUSTAIN = "Sustainability_Score"
HYGIENE = "HygieneScore"
RAMP_PCT = "Ramp_Access_Pct"
KEY = "District_Key"
LIBRARY = "Library_or_Reading_Corner_or_Book_Bank"
EXAM_YEAR = "Exam_Year"
PASS_PCT = "Pass_Pct"


def prepare(census: DataFrame, state_aliases=None) -> DataFrame:
    """State spelling fixes, applied before any aggregation."""
    return apply_aliases(census, STATE, state_aliases if state_aliases is not None else STATE_ALIASES)


def _desc(col: str):
    return F.col(col).desc_nulls_last()


# --- Q1: rural / urban / management -----------------------------------------


def split(census: DataFrame) -> DataFrame:
    return segments.split_totals(census, YS)


def split_ratio(census: DataFrame) -> DataFrame:
    out = segments.split_ratio(segments.split_totals(census, YS))
    return out.withColumn(segments.RATIO, round6(segments.RATIO)).orderBy(
        PERIOD, _desc(segments.RATIO), STATE
    )


def _rural_counts(census: DataFrame, name: str, private_only: bool = False) -> DataFrame:
    cond = F.col(LOCATION) == F.lit(RURAL)
    if private_only:
        cond = cond & (F.col(MGMT_ID) == F.lit(PRIVATE_UNAIDED_ID))
    return census.where(cond).groupBy(*YSD).agg(F.sum(TOTAL).alias(name))


def top_rural(census: DataFrame, n: int = TOP_N) -> DataFrame:
    counts = _rural_counts(census, segments.RURAL_COUNT)
    return ranking.top_n(counts, [_desc(segments.RURAL_COUNT), F.col(STATE), F.col(DISTRICT)],
                         n, by=[PERIOD])


def top_rural_per_state(census: DataFrame, n: int = TOP_N) -> DataFrame:
    counts = _rural_counts(census, segments.RURAL_COUNT)
    return ranking.top_n(counts, [_desc(segments.RURAL_COUNT), F.col(DISTRICT)], n, by=YS)


def top_private_rural(census: DataFrame, n: int = TOP_N) -> DataFrame:
    name = "Private_Rural_School_Count"
    counts = _rural_counts(census, name, private_only=True)
    return ranking.top_n(counts, [_desc(name), F.col(STATE), F.col(DISTRICT)], n, by=[PERIOD])


def mgmt_mix(census: DataFrame) -> DataFrame:
    return segments.mix(census)


def mgmt_share(census: DataFrame) -> DataFrame:
    out = segments.mix_share(segments.mix(census))
    return out.withColumn("Share_Pct", round6("Share_Pct"))


def state_mgmt_share(census: DataFrame) -> DataFrame:
    """Shares of (state, location, management) in a year: fine enough for
    slices at or below the label bound."""
    mixed = segments.mix(census, [PERIOD, STATE, LOCATION, MGMT_ID])
    return segments.mix_share(mixed, within=[PERIOD]).withColumn("Share_Pct", round6("Share_Pct"))


# --- Q4: self-sustainability -------------------------------------------------


def _sustain_districts(census: DataFrame) -> DataFrame:
    return scores.score_of_sums(rollup.facts(census), YSD, rollup.SUSTAIN, name=SUSTAIN, scale=100)


def sustain_top10(census: DataFrame, n: int = TOP_N) -> DataFrame:
    d = _sustain_districts(census).withColumn(SUSTAIN, round6(SUSTAIN))
    return ranking.top_n(d, [_desc(SUSTAIN), F.col(STATE), F.col(DISTRICT)], n, by=[PERIOD])


def sustain_state(census: DataFrame) -> DataFrame:
    s = scores.group_mean(_sustain_districts(census), YS, SUSTAIN)
    return s.withColumn(SUSTAIN, round6(SUSTAIN))


def sustain_by_mgmt(census: DataFrame) -> DataFrame:
    """Score per (year, state, management id): the first stage of the sector
    comparison, reported on its own."""
    s = scores.score_of_sums(rollup.facts(census), [*YS, MGMT_ID], rollup.SUSTAIN, name=SUSTAIN, scale=100)
    return s.withColumn(SUSTAIN, round6(SUSTAIN))


def sector(census: DataFrame, require_all: bool = False) -> DataFrame:
    out = segments.sector_compare(rollup.facts(census), rollup.SUSTAIN, YS, require_all=require_all)
    score_cols = [c for c in out.columns if c.endswith("_Score")]
    return out.select(*YS, *[round6(c).alias(c) for c in score_cols])


# --- Q2: accessibility, essential and advanced facilities --------------------


def ramp(census: DataFrame) -> DataFrame:
    out = rates.rate_gap_of_rows(rollup.facts(census), YS, "Ramps", RAMP_PCT, gap=rollup.gap("Ramps"))
    return out.orderBy(PERIOD, _desc(RAMP_PCT), STATE)


def essentials(census: DataFrame) -> DataFrame:
    return rates.rate_gap_of_sums(census, YS, ESSENTIALS)


def essentials_district(census: DataFrame) -> DataFrame:
    return rates.rate_gap_of_sums(census, YSD, DISTRICT_FEATURES)


def adv(census: DataFrame) -> DataFrame:
    return rates.rate_gap_of_sums(census, YS, ADVANCED)


def library_complement(census: DataFrame) -> DataFrame:
    lib = rates.rate_gap_of_sums(census, YS, {LIBRARY: LIBRARY})
    return rates.with_complement(lib, LIBRARY, "No_Library_Pct")


# --- Q5: medical check-up ----------------------------------------------------


def medical_lack(census: DataFrame) -> DataFrame:
    out = rates.lack_rate(census, YS, "Medical_Checkup", "No_Medical_Pct")
    return rates.with_complement(out, "No_Medical_Pct", "Medical_Pct")


def medical_complete_by_location(census: DataFrame) -> DataFrame:
    out = rates.have_rate(census, [PERIOD, LOCATION], "Complete_Medical_Checkup", "Complete_Medical_Pct")
    return rates.with_complement(out, "Complete_Medical_Pct", "No_Complete_Medical_Pct")


def medical_have(census: DataFrame) -> DataFrame:
    out = rates.have_rate(census, YS, "Medical_Checkup", "Medical_Available_Pct")
    return rates.with_complement(out, "Medical_Available_Pct", "No_Medical_Available_Pct")


# --- Q3: hygiene -------------------------------------------------------------


def _hygiene_districts(census: DataFrame) -> DataFrame:
    return scores.score_of_sums(rollup.facts(census), YSD, rollup.HYGIENE, name=HYGIENE)


def hygiene_district(census: DataFrame) -> DataFrame:
    """Hygiene score of every district, unranked."""
    return _hygiene_districts(census).withColumn(HYGIENE, round6(HYGIENE))


def hygiene_top10(census: DataFrame, n: int = TOP_N) -> DataFrame:
    d = _hygiene_districts(census).withColumn(HYGIENE, round6(HYGIENE))
    return ranking.top_n(d, [_desc(HYGIENE), F.col(STATE), F.col(DISTRICT)], n, by=[PERIOD])


def hygiene_above_mean(census: DataFrame) -> DataFrame:
    above = ranking.above_group_mean(_hygiene_districts(census), HYGIENE, by=[PERIOD],
                                     mean_name="Mean_HygieneScore", compare=round6)
    return above.select(*YSD, round6(HYGIENE).alias(HYGIENE),
                        round6("Mean_HygieneScore").alias("Mean_HygieneScore"))


def box(census: DataFrame, approx: bool = False) -> DataFrame:
    # Statistics of the unrounded district scores, rounded on output only:
    # quartiles and fences of 6-place inputs land exactly on half of the
    # 7th place, where engines round differently.
    return _rounded_box(distribution.box_stats(_hygiene_districts(census), YS, HYGIENE, approx=approx))


def box_rows(census: DataFrame) -> DataFrame:
    """``box`` over the scores of single rows, of which a state may have very
    many (of a census row by row, not of its rollup)."""
    rows = scores.hygiene_rows(census)
    return _rounded_box(distribution.box_stats(rows, YS, scores.ROW_SCORE, by_rank=True))


def _rounded_box(out: DataFrame) -> DataFrame:
    dbl = ["Q1", "Median", "Q3", "Min", "Max", "IQR", "Lower_Fence", "Upper_Fence",
           "Whisker_Low", "Whisker_High"]
    return out.select(*YS, *[round6(c).alias(c) for c in dbl], "N", "Outliers")


def hygiene_state(census: DataFrame) -> DataFrame:
    s = scores.group_mean(_hygiene_districts(census), YS, HYGIENE)
    return s.withColumn(HYGIENE, round6(HYGIENE)).orderBy(*YS)


# --- Trends (one column per academic year) ----------------------------------


def _trend(df: DataFrame, value: str, periods=None, complete_only: bool = True) -> DataFrame:
    return trends.wide_by_period(df, [STATE], PERIOD, value, periods, complete_only)


def trend_ramp(census: DataFrame, periods=None) -> DataFrame:
    return _trend(ramp(census), RAMP_PCT, periods)


def trend_internet(census: DataFrame, periods=None) -> DataFrame:
    return _trend(adv(census), "Internet", periods)


def trend_hygiene(census: DataFrame, periods=None) -> DataFrame:
    return _trend(hygiene_state(census), HYGIENE, periods)


def trend_sustain(census: DataFrame, periods=None) -> DataFrame:
    return _trend(sustain_state(census), SUSTAIN, periods)


def trend_medical(census: DataFrame, periods=None) -> DataFrame:
    return _trend(medical_have(census), "Medical_Available_Pct", periods)


# --- Correlation with the outcome table -------------------------------------


def _keyed(df: DataFrame, column: str, aliases) -> DataFrame:
    keyed = df.withColumn(KEY, normalize_key(column))
    return keyed if aliases is None else apply_aliases(keyed, KEY, aliases, mode="exact")


def aliases(census: DataFrame, census_aliases=None) -> DataFrame:
    """Each (state, district) of the census with its join key."""
    return _keyed(census.select(STATE, DISTRICT).distinct(), DISTRICT, census_aliases)


def aliases_in_order(census: DataFrame, census_aliases) -> DataFrame:
    """``aliases`` with the study's own, unanchored replacements, one after the
    other (``apply_aliases(mode="substring")``)."""
    keyed = census.select(STATE, DISTRICT).distinct().withColumn(KEY, normalize_key(DISTRICT))
    return apply_aliases(keyed, KEY, census_aliases, mode="substring")


def state_spelling(census: DataFrame, state_aliases) -> DataFrame:
    """What a fix of state spellings changes: per year and state as spelled, the
    schools under that spelling before it and after it."""
    totals = [c.groupBy(*YS).agg(F.sum(TOTAL).alias(n)) for n, c in (("Schools_Before", census), ("Schools_After", prepare(census, state_aliases)))]
    return totals[0].join(totals[1], YS, "full_outer")


def _joined_outcome(features: DataFrame, outcome: DataFrame, census_aliases=None,
                    outcome_aliases=None) -> DataFrame:
    left = _keyed(features, DISTRICT, census_aliases)
    state = [STATE] if STATE in outcome.columns else []
    right = _keyed(outcome, DISTRICT, outcome_aliases).select(KEY, EXAM_YEAR, PASS_PCT, *state)
    return correlate.join_outcome(left, right, KEY, KEY, PERIOD, EXAM_YEAR, state=STATE)


def in_states(census: DataFrame, states=None) -> DataFrame:
    """The census of the named states; of all without names."""
    return census if states is None else census.where(F.col(STATE).isin(*states))


def corr(census: DataFrame, outcome: DataFrame, census_aliases=None, outcome_aliases=None,
         null_policy: str = "skip", states=None) -> DataFrame:
    """Correlation of each district feature with the pass percentage, per
    year (``null_policy="zero"`` reproduces ``stat.corr`` on Spark 4.1);
    ``states`` limits the study to some states."""
    census = in_states(census, states)
    joined = _joined_outcome(essentials_district(census), outcome, census_aliases, outcome_aliases)
    out = correlate.feature_correlations(joined, [PERIOD], list(DISTRICT_FEATURES), PASS_PCT, null_policy)
    return out.withColumn(correlate.CORRELATION, round6(correlate.CORRELATION))


def corr_extremes(census: DataFrame, outcome: DataFrame, census_aliases=None,
                  outcome_aliases=None, null_policy: str = "skip", states=None) -> DataFrame:
    c = corr(census, outcome, census_aliases, outcome_aliases, null_policy, states)
    return correlate.extremes(c, list(DISTRICT_FEATURES), PERIOD)


def corr_hygiene(census: DataFrame, outcome: DataFrame, census_aliases=None,
                 outcome_aliases=None, null_policy: str = "skip", states=None) -> DataFrame:
    census = in_states(census, states)
    joined = _joined_outcome(_hygiene_districts(census), outcome, census_aliases, outcome_aliases)
    out = correlate.feature_correlations(joined, [PERIOD], [HYGIENE], PASS_PCT, null_policy)
    return out.withColumn(correlate.CORRELATION, round6(correlate.CORRELATION))


def fit_line(census: DataFrame, outcome: DataFrame, census_aliases=None, outcome_aliases=None,
             states=None) -> DataFrame:
    """Least-squares lines of pass % on library availability and on the
    hygiene score, per year. Both district features come from one
    aggregation of the census (same keys), joined once to the outcome."""
    per_district = rollup.facts(in_states(census, states)).groupBy(*YSD).agg(
        F.sum(TOTAL).alias("_t"),
        F.sum(LIBRARY).alias("_lib"),
        rollup.mean(rollup.HYGIENE).alias(HYGIENE),
    )
    feats = per_district.select(*YSD, pct_gap_of_sums("_t", "_lib").alias(LIBRARY), HYGIENE)
    joined = _joined_outcome(feats, outcome, census_aliases, outcome_aliases)
    fits = correlate.fit_lines(joined, [PERIOD], [LIBRARY, HYGIENE], PASS_PCT)
    return fits.select(PERIOD, correlate.FEATURE,
                       *[round6(c).alias(c) for c in ("Slope", "Intercept", "R2")], "N")


# --- Data quality ------------------------------------------------------------


def quality_compare(census: DataFrame) -> DataFrame:
    """Accessibility rate in the gap-of-sums form (expected) against the
    gap-of-rows form (observed): they differ where null ramp counts drop rows
    out of the gap but not out of the total. Both forms come from one
    aggregation of the census."""
    forms = rates.rate_forms(rollup.facts(census), YS, "Ramps", gap=rollup.gap("Ramps"))
    return quality.compare_columns(forms, YS, "Gap_Of_Sums_Pct", "Gap_Of_Rows_Pct", tol=0.0)


def quality_expected(census: DataFrame) -> DataFrame:
    """Per district, the ramp rate of all schools (expected) against that of
    its rural schools (observed): equal to a point, or not."""
    rural = census.where(F.col(LOCATION) == F.lit(RURAL))
    expected, observed = (rates.have_rate(c, YSD, "Ramps", "Ramp_Pct") for c in (census, rural))
    return quality.compare(expected, observed, YSD, "Ramp_Pct", tol=1.0)


def quality_expected_counts(census: DataFrame) -> DataFrame:
    """How many districts differ from the expected rate, per year."""
    return quality.summarize(quality_expected(census), [PERIOD])


def quality_summary(census: DataFrame) -> DataFrame:
    return quality.summarize(quality_compare(census), [PERIOD])


#: Points by which a state's rate in a year may differ from its rate over all years.
TOLERANCES = {"Functional_Boy_Toilet": 0, "Functional_Girl_Toilet": 1, "Handwash": 1, "Functional_Electricity": 2, "Playground": 3}


def quality_tolerances(census: DataFrame, tolerances: dict[str, float] | None = None) -> DataFrame:
    """Rates of each year and state against the state's over all years, each
    measure within its own tolerance."""
    tolerances = tolerances or TOLERANCES
    facts = rollup.rollup(census, YS)
    years = Window.partitionBy(STATE)  # one row per year
    summed = facts.select(*YS, F.sum(TOTAL).over(years).alias("_t"), *[F.sum(m).over(years).alias(m) for m in tolerances])
    observed, overall = (f.select(*YS, *[pct_gap_of_sums(t, m).alias(m) for m in tolerances]) for f, t in ((facts, TOTAL), (summed, "_t")))
    allowed = F.coalesce(*[F.when(F.col(quality.MEASURE) == m, F.lit(float(t))) for m, t in tolerances.items()])
    expected = quality.by_measure(overall, YS, list(tolerances), "Expected").withColumn("Tolerance", allowed)
    return quality.compare_measures(observed, expected, YS, list(tolerances))


def quality_tolerance_counts(census: DataFrame) -> DataFrame:
    """Passes and failures of ``quality_tolerances`` by year and measure."""
    return quality.summarize(quality_tolerances(census), [PERIOD, quality.MEASURE])


def quality_spread(census: DataFrame, limit: float = 2) -> DataFrame:
    counts = _rural_counts(census, segments.RURAL_COUNT)
    return quality.spread_below(counts, YS, segments.RURAL_COUNT, limit=limit)


CENSUS_ANALYSES = {
    "split": split,
    "split_ratio": split_ratio,
    "top_rural": top_rural,
    "top_rural_per_state": top_rural_per_state,
    "top_private_rural": top_private_rural,
    "mgmt_mix": mgmt_mix,
    "mgmt_share": mgmt_share,
    "state_mgmt_share": state_mgmt_share,
    "sustain_top10": sustain_top10,
    "sustain_state": sustain_state,
    "sustain_by_mgmt": sustain_by_mgmt,
    "sector": sector,
    "ramp": ramp,
    "essentials": essentials,
    "essentials_district": essentials_district,
    "adv": adv,
    "medical_lack": medical_lack,
    "medical_complete_by_location": medical_complete_by_location,
    "medical_have": medical_have,
    "library_complement": library_complement,
    "hygiene_district": hygiene_district,
    "hygiene_top10": hygiene_top10,
    "hygiene_above_mean": hygiene_above_mean,
    "box": box,
    "hygiene_state": hygiene_state,
    "trend_ramp": trend_ramp,
    "trend_internet": trend_internet,
    "trend_hygiene": trend_hygiene,
    "trend_sustain": trend_sustain,
    "trend_medical": trend_medical,
    "aliases": aliases,
    "quality_compare": quality_compare,
    "quality_expected": quality_expected,
    "quality_expected_counts": quality_expected_counts,
    "quality_summary": quality_summary,
    "quality_spread": quality_spread,
    "quality_tolerances": quality_tolerances,
    "quality_tolerance_counts": quality_tolerance_counts,
}
OUTCOME_ANALYSES = {
    "corr": corr,
    "corr_extremes": corr_extremes,
    "corr_hygiene": corr_hygiene,
    "fit_line": fit_line,
}
