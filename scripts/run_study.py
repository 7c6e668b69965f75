"""Run the whole study on a census in the original folder layout.

    python scripts/run_study.py --census <base>/ [--outcome results.csv] --out <dir> [--format parquet]

``<base>`` holds ``<year>/<state>/*.csv`` (or ``Academic_Year=<year>/
State_Name=<state>/``); ``--census-parquet`` reads a census written by
``write_census`` instead. The optional results sheet has the side-by-side
layout (``Districts1,2017,Districts2,2018,...``); its district names are
mapped to census spelling with the study's alias list. CSV input is parsed once,
into ``<out>/_census/``; every analysis is written to ``<out>/<name>/``.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(spark, census_path: str, out: str, outcome_path: str | None = None, fmt: str = "parquet",
        census_format: str = "csv", only=None, corr_nulls: str = "skip",
        complete_outcome: bool = False, states=None) -> list[str]:
    from censuskit.operators.normalize import EXAM_DISTRICT_ALIASES
    from censuskit.operators.rollup import rollup
    from censuskit.plans import study
    from censuskit.sources.census import read_census, read_census_csv, write_census
    from censuskit.sources.outcome import outcome_long, read_outcome_csv

    if census_format == "csv":  # parsed once; every analysis reads the Parquet copy
        copy = f"{out.rstrip('/')}/_census"
        write_census(read_census_csv(spark, census_path), copy)
        census_path = copy
    # One scan of the census; every analysis reads what it comes to.
    rolled = f"{out.rstrip('/')}/_rollup"
    rollup(study.prepare(read_census(spark, census_path))).write.mode("overwrite").parquet(rolled)
    census = spark.read.parquet(rolled)
    results = {name: fn(census) for name, fn in study.CENSUS_ANALYSES.items()}
    if outcome_path:
        outcome = outcome_long(read_outcome_csv(spark, outcome_path), complete_only=complete_outcome,
                               aliases=EXAM_DISTRICT_ALIASES)
        for name, fn in study.OUTCOME_ANALYSES.items():
            kw = {"null_policy": corr_nulls} if name != "fit_line" else {}
            results[name] = fn(census, outcome, states=states, **kw)
    written = []
    for name, df in results.items():
        if only and name not in only:
            continue
        df.write.mode("overwrite").format(fmt).option("header", True).save(f"{out.rstrip('/')}/{name}")
        written.append(name)
    return written


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--census", help="base folder of <year>/<state>/*.csv")
    ap.add_argument("--census-parquet", help="census written by write_census")
    ap.add_argument("--outcome", help="results sheet (CSV)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    ap.add_argument("--corr-nulls", default="skip", choices=["skip", "zero"],
                    help="zero: a missing value counts as 0 in correlations (the study's numbers)")
    ap.add_argument("--complete-outcome", action="store_true",
                    help="keep only districts listed in every exam year (the study's inner join)")
    ap.add_argument("--corr-state", action="append", help="limit the correlation study to this state (repeatable)")
    args = ap.parse_args()
    if not (args.census or args.census_parquet):
        ap.error("one of --census or --census-parquet is required")

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("censuskit-study").getOrCreate()
    names = run(spark, args.census or args.census_parquet, args.out, args.outcome, args.format,
                "csv" if args.census else "parquet", corr_nulls=args.corr_nulls,
                complete_outcome=args.complete_outcome, states=args.corr_state)
    print(f"wrote {len(names)} results under {args.out}")
    spark.stop()


if __name__ == "__main__":
    main()
