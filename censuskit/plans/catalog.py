"""The study bound to the driver tables: one ``(spark, sf_dir)`` callable per
analysis, as registered in ``__spark_entry__.queries()``.

The census is the one derived from the driver tables; its analyses read the
rollup of it (``statistics``, materialised once per session); the outcome is the exam-result table derived
from orders; census district names reach the outcome spelling through an
alias table derived from the nation table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censuskit.operators import quality
from censuskit.operators.normalize import ALIAS_FROM, ALIAS_ORDER, ALIAS_TO, normalize_key
from censuskit.operators.rollup import rollup
from censuskit.plans import study
from censuskit.schema import DISTRICT, LOCATION, STATE, URBAN
from censuskit.sources import storage
from censuskit.sources.census import DERIVATION_VERSION, YEAR_OFFSET, apply_null_policy, census_inputs, census_table, derived_census, geography
from censuskit.sources.outcome import EXAM_YEAR, PASS_PCT, bad_outcome_values, outcome_sheet, outcome_table
from censuskit.sources.outcome import outcome_long as _stack_outcome

# Order years of the driver tables, and the academic and exam years they become.
# They name the columns of the trend tables; another year is an error there.
ORDER_YEARS = range(1995, 2002)
PERIODS = [f"{y + YEAR_OFFSET}_{y + YEAR_OFFSET + 1}" for y in ORDER_YEARS]
EXAM_YEARS = [str(y + YEAR_OFFSET) for y in ORDER_YEARS]
# States of the correlation study that is limited to some.
CORR_STATES = ["AFRICA", "ASIA"]
# Rows of a top list per state: fewer than a state has districts.
TOP_PER_STATE = 3
# Spread of rural school counts that passes.
SPREAD_LIMIT = 3000


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The census row by row."""
    return study.prepare(census_table(spark, sf_dir))


def statistics(spark: SparkSession, sf_dir: str, null_policy: str = "keep") -> DataFrame:
    """The rollup of the census, written once per session: the one scan behind
    every analysis of sums. The derivation's join feeds the aggregate directly."""
    d = sf_dir.rstrip("/")
    return storage.materialize(
        spark,
        "rollup" if null_policy == "keep" else f"rollup-{null_policy}",
        census_inputs(d),
        DERIVATION_VERSION,
        build=lambda: rollup(apply_null_policy(study.prepare(derived_census(spark, d)), null_policy)),
        write=lambda df, path: df.write.mode("overwrite").parquet(path),
        read=lambda path: spark.read.parquet(path),
    )


def district_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table (census spelling -> results spelling) derived from the
    nation table: ``NATION_7`` is written ``Nation 7`` in the results."""
    nation = storage.read_table(spark, f"{sf_dir.rstrip('/')}/nation.parquet")
    return nation.select(
        normalize_key("n_name").alias(ALIAS_FROM),
        normalize_key(F.regexp_replace("n_name", "NATION_", "Nation ")).alias(ALIAS_TO),
    )


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long outcome table (materialised once per session; the sheet
    layout of ``outcome_long`` stacks back to exactly these rows)."""
    return outcome_table(spark, sf_dir)


def outcome_long(spark, sf_dir):
    """The results-sheet layout built from the driver tables, stacked back to
    one row per (district, exam year)."""
    return _stack_outcome(outcome_sheet(spark, sf_dir, long=outcome_table(spark, sf_dir), years=EXAM_YEARS))


# A mean below the bar is written otherwise in the lists.
OTHER_SPELLING_BELOW = 50.0
NO_NUMBER_BELOW = 50.0


def outcome_complete(spark, sf_dir):
    """Districts listed in every exam year, from the lists of all orders: a
    district that had none in a year is not in that year's list. Lists spell a
    district another way where its mean is low; the spellings are mended before
    the lists are compared."""
    other = F.regexp_replace(DISTRICT, "Nation ", "NATION-")
    long = outcome_table(spark, sf_dir)
    long = long.withColumn(DISTRICT, F.when(F.col(PASS_PCT) < OTHER_SPELLING_BELOW, other).otherwise(F.col(DISTRICT)))
    nation = storage.read_table(spark, f"{sf_dir.rstrip('/')}/nation.parquet")
    aliases = nation.select(
        normalize_key(F.regexp_replace("n_name", "NATION_", "NATION-")).alias(ALIAS_FROM),
        normalize_key(F.regexp_replace("n_name", "NATION_", "Nation ")).alias(ALIAS_TO),
    )
    sheet = outcome_sheet(spark, sf_dir, long=long, years=EXAM_YEARS)
    return _stack_outcome(sheet, complete_only=True, aliases=aliases)


def outcome_bad(spark, sf_dir):
    """The cells of a results sheet that hold no number: a low mean is written
    in words there."""
    low = F.concat(F.lit("below "), F.lit(str(NO_NUMBER_BELOW)))
    long = outcome_table(spark, sf_dir).withColumn(PASS_PCT, F.when(F.col(PASS_PCT) < NO_NUMBER_BELOW, low).otherwise(F.col(PASS_PCT).cast("string")))
    sheet = outcome_sheet(spark, sf_dir, long=long, years=EXAM_YEARS, line="Sheet_Line")
    return bad_outcome_values(sheet, "Sheet_Line")


def outcome_bad_counts(spark, sf_dir):
    """How many cells of each list hold no number."""
    return outcome_bad(spark, sf_dir).groupBy(EXAM_YEAR).agg(F.count("*").alias("Bad_Cells"))


def aliases_in_order(spark, sf_dir):
    """District keys by unanchored replacements in order: a nation's name is
    replaced within longer names, too, and what came of it is replaced again."""
    nation = storage.read_table(spark, f"{sf_dir.rstrip('/')}/nation.parquet")
    name = normalize_key("n_name")
    short = nation.select(F.col("n_nationkey").alias(ALIAS_ORDER), name.alias(ALIAS_FROM), F.concat(F.lit("n"), F.col("n_nationkey"), F.lit("-")).alias(ALIAS_TO))
    region = storage.read_table(spark, f"{sf_dir.rstrip('/')}/region.parquet")
    again = region.select(
        (F.col("r_regionkey") + 1000).alias(ALIAS_ORDER), F.concat(F.lit("n"), F.col("r_regionkey"), F.lit("-")).alias(ALIAS_FROM), F.concat(F.lower("r_name"), F.lit(" ")).alias(ALIAS_TO)
    )
    return study.aliases_in_order(statistics(spark, sf_dir), short.unionByName(again))


def _ward(column) -> F.Column:
    """A name that one district of each state has."""
    return F.concat(F.lit("Ward "), F.floor(F.regexp_extract(column, "([0-9]+)", 1).cast("int") / 5).cast("string"))


def corr_by_state(spark, sf_dir):
    """``corr`` where districts of different states share names: features and
    results meet by state, too."""
    census = statistics(spark, sf_dir).withColumn(DISTRICT, _ward(DISTRICT))
    states = geography(spark, sf_dir).select(F.col(STATE), normalize_key(F.regexp_replace(DISTRICT, "NATION_", "Nation ")).alias("_name"))
    results = outcome(spark, sf_dir)
    results = results.join(states, normalize_key(DISTRICT) == F.col("_name")).select(STATE, _ward(DISTRICT).alias(DISTRICT), EXAM_YEAR, PASS_PCT)
    return study.corr(census, results)


def ramp_zero(spark, sf_dir):
    """``ramp`` where a missing count is zero: its rows stay in the gap."""
    return study.ramp(statistics(spark, sf_dir, "zero"))


def state_spelling(spark, sf_dir):
    """The fix of a state's spelling, which urban rows write another way."""
    spelled = F.when(F.col(LOCATION) == URBAN, F.lower(STATE)).otherwise(F.col(STATE))
    region = storage.read_table(spark, f"{sf_dir.rstrip('/')}/region.parquet")
    fixes = region.select(F.lower("r_name").alias(ALIAS_FROM), F.col("r_name").alias(ALIAS_TO))
    return study.state_spelling(statistics(spark, sf_dir).withColumn(STATE, spelled), fixes)


def box_rows(spark, sf_dir):
    """Quartiles of single rows' hygiene scores, by rank."""
    return study.box_rows(census(spark, sf_dir))


def quality_unique(spark, sf_dir):
    """Keys that should occur once, and how many do not: orders by their key,
    line items by order and line number."""
    parts = []
    for name, keys in {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}.items():
        table = storage.read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        parts.append(quality.count_unexpected(table, keys).select(F.lit(name).alias("Check_Name"), "Keys", "Unexpected"))
    return parts[0].unionByName(parts[1])


def corr_states(spark, sf_dir):
    """``corr`` limited to some states, as the study's was to one."""
    return study.corr(statistics(spark, sf_dir), outcome(spark, sf_dir),
                      census_aliases=district_aliases(spark, sf_dir), states=CORR_STATES)


def _bind_census(fn, **options):
    def run(spark, sf_dir):
        return fn(statistics(spark, sf_dir), **options)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _bind_outcome(fn):
    def run(spark, sf_dir):
        return fn(statistics(spark, sf_dir), outcome(spark, sf_dir),
                  census_aliases=district_aliases(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def aliases(spark, sf_dir):
    return study.aliases(statistics(spark, sf_dir), census_aliases=district_aliases(spark, sf_dir))


_OPTIONS = {name: {"periods": PERIODS} for name in study.CENSUS_ANALYSES if name.startswith("trend_")}
_OPTIONS |= {"top_rural_per_state": {"n": TOP_PER_STATE}, "quality_spread": {"limit": SPREAD_LIMIT}}
QUERIES = {name: _bind_census(fn, **_OPTIONS.get(name, {})) for name, fn in study.CENSUS_ANALYSES.items()}
QUERIES["outcome_long"] = outcome_long
QUERIES["outcome_complete"] = outcome_complete
QUERIES["outcome_bad"] = outcome_bad
QUERIES["outcome_bad_counts"] = outcome_bad_counts
QUERIES["quality_unique"] = quality_unique
QUERIES["corr_states"] = corr_states
QUERIES["corr_by_state"] = corr_by_state
QUERIES["aliases"] = aliases
QUERIES["aliases_in_order"] = aliases_in_order
QUERIES["ramp_zero"] = ramp_zero
QUERIES["state_spelling"] = state_spelling
QUERIES["box_rows"] = box_rows
QUERIES.update({name: _bind_outcome(fn) for name, fn in study.OUTCOME_ANALYSES.items()})
