"""The study on a census in the original CSV folder layout equals the study
on the Parquet census it was exported from."""

import os

from censuskit.plans import catalog, study
from censuskit.sources.census import census_table, read_census_csv
from scripts.run_study import run
from tests.conftest import SF001, rows


def test_csv_census_gives_same_results(spark, tmp_path):
    base = str(tmp_path / "census_csv")
    census_table(spark, SF001).write.partitionBy("Academic_Year", "State_Name").option("header", True).csv(base)
    from_csv = study.prepare(read_census_csv(spark, base))
    from_parquet = catalog.census(spark, SF001)
    for name in ("split", "essentials", "hygiene_top10", "sector", "trend_medical", "box"):
        fn = study.CENSUS_ANALYSES[name]
        assert rows(fn(from_csv)) == rows(fn(from_parquet)), name


def test_runner_writes_every_result(spark, tmp_path):
    base = str(tmp_path / "census")
    census_table(spark, SF001).write.partitionBy("Academic_Year", "State_Name").option("header", True).csv(base)
    sheet = tmp_path / "results.csv"
    sheet.write_text("Districts1,2017,Districts2,2018,Districts3,2019\n"
                     "NATION_1,70.5,NATION_1,71.0,NATION_2,60\n"
                     "NATION_2,55.25,NATION_2,58,NATION_1,61\n")
    out = str(tmp_path / "out")
    names = run(spark, base, out, str(sheet), only=["split", "corr", "fit_line", "quality_summary"],
                corr_nulls="zero", complete_outcome=True, states=["AMERICA", "ASIA"])
    assert sorted(names) == ["corr", "fit_line", "quality_summary", "split"]
    for n in names:
        assert spark.read.parquet(os.path.join(out, n)).count() > 0
