"""The mix against a sequential version, and its schedules by integration."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import pytest

from censuskit.llm import mixing
from tests.conftest import SF01

DOCS = "doc_id long, source string, text string, order int, target string"


def targets(sizes, weights, most):
    """Shared again and again until none is above its cap."""
    left, out, total = {s for s in sizes if weights.get(s, 0) > 0}, dict.fromkeys(sizes, 0.0), sum(sizes.values())
    while left:
        level = total / sum(weights[s] for s in left)
        over = {s for s in left if level * weights[s] > most * sizes[s]}
        if not over:
            return out | {s: level * weights[s] for s in left}
        out |= {s: float(most * sizes[s]) for s in over}
        total -= sum(most * sizes[s] for s in over)
        left -= over
    return out


def weight_at(knots, t):
    knots = sorted(knots)
    if t <= knots[0][0]:
        return knots[0][1]
    for (a, v), (b, w) in zip(knots, knots[1:]):
        if t <= b:
            return v + (w - v) * (t - a) / (b - a)
    return knots[-1][1]


def integral(knots, upto, steps=4000):
    return sum(weight_at(knots, upto * (i + 0.5) / steps) for i in range(steps)) * upto / steps


def brute(rows, knots, most=3):
    """Row by row: size, source size, target, taken and reads as (turn, words, offset)."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    digest = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[2] or ''}".encode()).hexdigest()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[1]] += size(r[2])
    weights = {s: integral(k, 1.0) for s, k in knots.items()}
    aims = targets(sizes, weights, most)
    out, start = [], defaultdict(int)
    for r in sorted(rows, key=digest):
        s, n = r[1], size(r[2])
        goal, reads, turn = int(aims[s] + 0.5), [], 0
        while n and turn * sizes[s] + start[s] < goal:
            reads.append((turn, min(n, goal - turn * sizes[s] - start[s]), turn * sizes[s] + start[s]))
            turn += 1
        start[s] += n
        out.append((r[0], s, n, sizes[s], aims[s], reads))
    return out


def table(seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot", "hot", "hot", "é", "z", None]), " ".join(["w"] * rng.choice([0, 1, 2, 5, 40, 300]))) for i in range(400)]
    rows += [(1000, "tiny", "one two three"), (1001, "tiny", "four\tfive\n"), (1002, "blank", " \n "), (1003, "blank", None), (1004, "long", "word " * 100_000)]
    rows += [(7, "hot", "alike rows of one key")] * 25 + [(7, "hot", "another text")] + [(None, "z", "no key")] * 3 + [(8, None, None)] * 2
    return [(*r, 1, "x") for r in rows]


KNOTS = {"hot": [(0.0, 1.0), (0.5, 0.0), (1.0, 3.0)], "é": [(0.25, 2.0), (0.75, 0.5)], "z": [(0.0, 1.0)], "tiny": [(0.0, 5.0), (1.0, 1.0)], "blank": [(0.0, 1.0)], None: [(0.0, 0.0), (0.5, 0.0), (1.0, 2.0)], "long": [(0.0, 0.2), (1.0, 0.1)]}


@pytest.mark.parametrize("run", [3, 10_000])
def test_equals_the_sequential_mix(spark, monkeypatch, run):
    monkeypatch.setattr(mixing, "RUN", run)  # 25 rows alike are told apart over several runs
    rows = table()
    schedule = spark.createDataFrame([(s, *k) for s, ks in KNOTS.items() for k in ks], "source string, at double, weight double")
    got = mixing.plan(spark.createDataFrame(rows, DOCS).repartition(6), schedule).collect()
    want = brute(rows, KNOTS)
    key = lambda x: tuple((v is None, v) for v in x)
    a = sorted(((r.doc_id, r.source, r["size"], r.source_size, r.taken, [(x.turn, x.words) for x in r.reads]) for r in got), key=key)
    b = sorted(((d, s, n, z, sum(x[1] for x in reads), [x[:2] for x in reads]) for d, s, n, z, _, reads in want), key=key)
    assert a == b
    goal = {s: t for _, s, _, _, t, _ in want}
    assert all(r.target == pytest.approx(goal[r.source], rel=1e-6) and r.taken <= 3 * r["size"] for r in got)
    # The scheduled demand at a read's position is what its source gave before.
    offset = {(d, s, t): o for d, s, _, _, _, reads in want for t, _, o in reads if d != 7 and d is not None}
    area = {s: integral(k, 1.0) for s, k in KNOTS.items()}
    checked = 0
    for r in random.Random(5).sample([r for r in got if r.reads and r.doc_id not in (7, None)], 60):
        for x in r.reads:
            o = offset[r.doc_id, r.source, x.turn]
            assert r.target * integral(KNOTS[r.source], x.position) / area[r.source] == pytest.approx(o, abs=max(2e-3 * r.target, 1e-6))
            checked += 1
    assert checked > 60 and {"tiny", "long"} <= {r.source for r in got if r.reads}


def test_curriculum_is_sorted_over_partitions(spark):
    rows = table()
    df = spark.createDataFrame(rows, DOCS)
    schedule = mixing.rotating_schedule(df)
    got = mixing.curriculum(df, schedule)
    parts = got.rdd.glom().collect()  # tests only
    listed = [r for p in parts for r in p]
    assert sum(len(p) > 0 for p in parts) > 1
    assert [r.position for r in listed] == sorted(r.position for r in listed) and 0 <= listed[0].position and listed[-1].position < 1
    taken = defaultdict(int)
    for r in mixing.document_mix(df, schedule).collect():
        taken[r.doc_id] += r.taken
    for r in listed:
        taken[r.doc_id] -= r.words
    assert not any(taken.values())
    again = mixing.curriculum(df.repartition(3), schedule).collect()
    assert sorted(map(str, again)) == sorted(map(str, listed))


def test_schedules(spark):
    df = spark.createDataFrame([(s,) for s in ["b", "a", None, "É", "a"]], "source string")
    got = {r.source: r.weight for r in mixing.integrated(mixing.rotating_schedule(df)).collect()}
    assert got == {"a": 1.0, "b": 2.0, "É": 3.0, None: 1.0}
    odd = [("a", 0.0, -1.0), ("a", 1.0, float("nan")), ("b", None, 5.0), ("c", 0.5, 2.0), ("c", 0.5, 4.0), ("d", 7.0, 1.0), ("e", 0.0, None), ("e", 1.0, 2.0)]
    got = {r.source: r.weight for r in mixing.integrated(spark.createDataFrame(odd, "source string, at double, weight double")).collect()}
    assert got == {"a": 0.0, "c": 4.0, "e": 1.0}


def test_empty_tables_and_sources_without_weight(spark):
    df = spark.createDataFrame(table(), DOCS)
    assert mixing.document_mix(df.limit(0), mixing.rotating_schedule(df)).count() == 0
    assert mixing.rotating_schedule(df.limit(0)).count() == 0
    none = mixing.document_mix(df, mixing.rotating_schedule(df.limit(0))).collect()
    assert len(none) == len(table()) and {(r.target, r.taken, r.first_position) for r in none} == {(0.0, 0, None)}
    only = spark.createDataFrame([("tiny", 0.0, 1.0)], "source string, at double, weight double")
    assert sum(r.taken for r in mixing.document_mix(df, only).collect()) == 3 * 5
    empty = spark.createDataFrame([(1, "a", None, 1, "x"), (2, "b", " ", 1, "x")], DOCS)
    assert {(r["size"], r.target, r.taken) for r in mixing.document_mix(empty, mixing.rotating_schedule(empty)).collect()} == {(0, 0.0, 0)}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(table()[:5], DOCS)
    plan = mixing.document_mix(df, mixing.rotating_schedule(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_equals_sql(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF01}/documents.parquet'")
    key = lambda x: tuple((v is None, v) for v in x)
    got = mixing.document_mix(df, mixing.rotating_schedule(df)).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(con.sql(mixing.MIX_SQL).fetchall(), key=key)
