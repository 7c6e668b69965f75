"""Print the final physical plan (operators only) of chosen queries.

Usage: python scripts/show_plans.py [sf_dir] [query ...]
Collects each query once so that the adaptive plan is final, then prints the
operator tree without attribute lists.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compact(plan: str) -> str:
    final = plan.split("+- == Initial Plan ==")[0]
    out = []
    for ln in final.splitlines():
        if "== Final Plan ==" in ln or not ln.strip():
            continue
        ln = re.sub(r"#\d+L?", "", ln)
        ln = re.sub(r"\[plan_id=\d+\]", "", ln)
        ln = re.sub(r"(Project|HashAggregate|ObjectHashAggregate|Expand)\b.*", r"\1", ln)
        ln = re.sub(r"(FileScan parquet) \[[^\]]*\].*?(PushedFilters: \[[^\]]*\])?.*", r"\1 \2", ln)
        out.append(ln.rstrip()[:150])
    return "\n".join(out)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from pyspark.sql import SparkSession

    from censuskit.plans import QUERIES
    from censuskit.sources.census import derived_census

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = derived_census(spark, sf_dir) if name == "derived_census" else QUERIES[name](spark, sf_dir)
        df.collect()
        print(f"### {name}\n```\n{compact(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
