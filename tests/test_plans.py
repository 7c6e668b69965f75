"""Plan shape: no Python UDFs, pruned scans, pushed filters, one fact shuffle join."""

import pytest

from censuskit.operators.rollup import rollup
from censuskit.plans import QUERIES, catalog, study
from censuskit.sources.census import derived_census
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_census_scan_is_pruned(spark):
    df = study.ramp(catalog.census(spark, SF001))
    plan = _plan(df)
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    schema = scan[scan.index("ReadSchema"):]
    assert "l_partkey" in schema and "District_Name" not in schema and "Location" not in schema
    assert plan.count(" % cast(") + plan.count(" % ") < 12  # the measures of other queries are not computed


def test_rural_filter_is_pushed(spark):
    for census in (catalog.census(spark, SF001), catalog.statistics(spark, SF001)):
        plan = _plan(study.top_rural(census))
        assert "IsNotNull(Location), EqualTo(Location,Rural)" in plan


def test_derivation_join_shape(spark):
    plan = _plan(derived_census(spark, SF001))
    assert plan.count("SortMergeJoin") == 1
    assert "lambda" not in plan and "transform(" not in plan


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _raw_census_shuffles(node, below_exchange=False, seen_agg=False):
    """Exchanges that move census rows with no aggregate between the scan and
    the exchange."""
    name = node.getClass().getSimpleName()
    bad = []
    if name == "ShuffleExchangeExec":
        below_exchange, seen_agg = True, False
    elif name in ("HashAggregateExec", "ObjectHashAggregateExec", "SortAggregateExec"):
        seen_agg = True
    elif name == "FileSourceScanExec" and below_exchange and not seen_agg:
        roots = node.relation().location().rootPaths().mkString(",")
        if "censuskit/census-" in roots:
            bad.append(node.toString()[:120])
    for child in _children(node):
        bad += _raw_census_shuffles(child, below_exchange, seen_agg)
    return bad


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_census_rows_are_aggregated_before_any_shuffle(spark, name):
    """A hot key (one state with a third of the rows) is combined map-side:
    no exchange above the census scan carries raw rows."""
    df = QUERIES[name](spark, SF001)
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # A new Dataset is planned under the setting in force (AQE off, so
        # the tree is the plain physical plan).
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        assert _raw_census_shuffles(plan) == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_year_filter_prunes_census_folders(spark):
    one_year = catalog.census(spark, SF001).where("Academic_Year = '2019_2020'")
    plan = _plan(study.essentials(one_year))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "PartitionFilters: [isnotnull(Academic_Year" in scan and "2019_2020" in scan


def _scanned(df) -> set[str]:
    """The folders that a plan reads."""
    found, todo = set(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "LogicalRelation":
            found.add(node.relation().location().rootPaths().mkString(","))
        todo += _children(node)
    return found


def test_one_census_scan_serves_every_analysis(spark):
    rolled = _scanned(catalog.statistics(spark, SF001))
    assert len(rolled) == 1 and "censuskit/rollup-" in next(iter(rolled))
    small = ("nation.parquet", "censuskit/outcome-")  # spellings and results
    for name in [*study.CENSUS_ANALYSES, *study.OUTCOME_ANALYSES]:
        assert {x for x in _scanned(QUERIES[name](spark, SF001)) if not any(y in x for y in small)} == rolled, name
    inputs = _scanned(rollup(study.prepare(derived_census(spark, SF001))))
    assert sum("lineitem" in x for x in inputs) == 1


def test_rollup_is_map_side_combined_and_rolls_up_again(spark):
    rows = derived_census(spark, SF001)
    once = rollup(rows)
    plan = _plan(once.select("*"))
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan
    keys = ["Academic_Year", "State_Name"]
    a, b = ({tuple(r[k] for k in keys): r for r in rollup(x, keys).collect()} for x in (rows, once))
    assert a.keys() == b.keys()
    for k, r in a.items():
        for c, v in r.asDict().items():
            assert b[k][c] == v or b[k][c] == pytest.approx(v, rel=1e-12), c
    assert sum(r["_rows"] for r in a.values()) == rows.count() > once.count()
