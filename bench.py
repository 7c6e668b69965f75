"""Benchmark: run the catalogue queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_and_build_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``census_build`` and ``outcome_build`` are the one-off derivations of the
census (five-table join, written as partitioned Parquet) and of the outcome
table from the driver tables; every query then runs on those tables and is
timed to a full ``collect`` of its result. Each query is run ``BENCH_REPEAT``
times (default 3); ``queries`` has the best time, ``first_run`` the first, which
also pays code generation and JIT. ``value`` is the sum of the best times and of
both builds.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


# (all years in one run; the reference looped over years and states).
BASELINE_GROUPS = {
    "Q1a_rural_urban_split": ["split", "split_ratio"],
    "Q1b_top_rural_districts": ["top_rural", "top_rural_per_state"],
    "Q1c_private_rural_top10_and_mix": ["top_private_rural", "mgmt_mix", "mgmt_share"],
    "Q2a_accessibility_and_trend": ["ramp", "trend_ramp"],
    "Q2b_essential_rates": ["essentials"],
    "Library_availability": ["library_complement"],
    "Q2c_advanced_rates_and_trend": ["adv", "trend_internet"],
    "Q3_hygiene_all_parts": ["hygiene_top10", "hygiene_above_mean", "box", "hygiene_state", "trend_hygiene"],
    "Q4a_sustainability_and_trend": ["sustain_top10", "sustain_state", "trend_sustain"],
    "Q4b_sector_comparison": ["sector"],
    "Q5a_lacking_checkup": ["medical_lack"],
    "Q5b_complete_checkup_by_location": ["medical_complete_by_location"],
    "Q5c_having_checkup_and_trend": ["medical_have", "trend_medical"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark.sql import SparkSession

    from censuskit import session

    input_bytes = sum(
        os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir) if f.endswith(".parquet")
    ) if os.path.isdir(sf_dir) else 0
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("censuskit-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    )
    spark = session.apply(builder, input_bytes, int(cpus)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-"))

    from censuskit.plans import QUERIES
    from censuskit.plans.catalog import statistics
    from censuskit.sources.outcome import outcome_table

    # JVM/JIT warm-up on a throwaway job, outside every timing.
    t0 = time.perf_counter()
    spark.range(1_000_000).selectExpr("sum(id % 7)").collect()
    warmup = round(time.perf_counter() - t0, 3)

    # One-off derived tables (written once per session, reused by queries).
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    statistics(spark, sf_dir).count()
    timings["census_build"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    outcome_table(spark, sf_dir).count()
    timings["outcome_build"] = round(time.perf_counter() - t0, 3)
    first_run = dict(timings)

    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(max(1, repeat)):
            t = time.perf_counter()
            fn(spark, sf_dir).collect()
            dt = time.perf_counter() - t
            first_run.setdefault(name, round(dt, 3))
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    total = round(sum(timings.values()), 3)
    groups = {
        label: round(sum(timings.get(q, 0.0) for q in qs), 3)
        for label, qs in BASELINE_GROUPS.items()
        if all(q in timings for q in qs)
    }
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_and_build_sec",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "first_run": first_run,
                "first_run_total": round(sum(first_run.values()), 3),
                "warmup_sec": warmup,
                "baseline_cells": groups,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
