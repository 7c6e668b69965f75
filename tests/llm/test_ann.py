"""Inverted multi-index against brute force."""

import numpy as np
import pytest

from censuskit.llm import ann
from tests.conftest import SF01


def brute(rows, queries, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    asked = {i: np.array(v, float) for i, v in queries if i in ok}
    out = {}
    for i, q in asked.items():
        scores = sorted((-float(sum(a * b for a, b in zip(q, v))), j) for j, v in ok.items() if j != i)
        out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found = out.setdefault(r.query_id, [])
        assert r.rank == len(found) + 1
        found.append((r.vec_id, r.score))
    return out


def test_exact_when_everything_is_visited(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(400, None), (401, [0.0] * 6), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] * 6), (404, [float("inf"), 0.0, 0.0, 0.0, 0.0, 1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    asked = df.where("vec_id % 20 = 0 or vec_id in (7, 310, 403)")
    want = brute(rows, [(i, v) for i, v in rows if i is not None and (i % 20 == 0 or i in (7, 310, 403))], 5)
    got = answers(ann.search(df, asked, k=5))
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in want.items()}
    assert all(s == t for q in got for (_, s), (_, t) in zip(got[q], want[q]))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [3.0, -1.0])], "vec_id long, embedding array<float>")
    got = answers(ann.search(df, df.where("vec_id = 0"), k=20))
    assert got == {0: [(1, 1.5), (2, 1.0)]}
    assert ann.search(df.limit(0), df, k=3).count() == 0
    assert ann.search(df, df.limit(0), k=3).count() == 0
    one = df.where("vec_id = 0")
    assert ann.search(one, one, k=3).count() == 0


def test_heap_order():
    a, b = np.array([0.3, 0.9, -0.2]), np.array([0.1, 0.5])
    got = [a[i] + b[j] for i, j in ann.cells_in_order(a, b)]
    assert got == sorted(got, reverse=True) and len(got) == 6


@pytest.mark.parametrize("least,floor", [(ann.LEAST, 1.0), (10, 0.9)])
def test_recall(spark, least, floor):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    want = brute(rows, [x for x in rows if x[0] % 20 == 0], 20)
    got = answers(ann.search(df, df.where("vec_id % 20 = 0"), k=20, least=least))
    assert all(len(x) == 20 for x in got.values()) and set(got) == set(want)
    recall = np.mean([len({j for j, _ in want[q]} & {j for j, _ in got[q]}) / 20 for q in want])
    assert recall >= floor


def test_one_key_on_a_third_of_the_rows_and_stray_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)] + [(7, rng.normal(size=6).tolist()) for _ in range(150)]
    rows += [(-5, [1.0, 2.0]), (10**6, [9.0] * 7), (10**6 + 1, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, row int").repartition(5)
    got = ann.search(df, df.where("vec_id % 20 = 0"), k=5).collect()
    whole = [(k, np.array(v, np.float32).astype(float)) for k, v in rows if len(v) == 6]
    for q in {k for k, _ in whole if k % 20 == 0}:
        v = next(v for k, v in whole if k == q)
        want = sorted((-sum(a * b for a, b in zip(v.tolist(), w.tolist())), k) for k, w in whole if k != q)[:5]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.vec_id for r in mine] == [k for _, k in want] and [r.score for r in mine] == pytest.approx([-s for s, _ in want])
    assert {r.query_id for r in got} == {k for k, _ in whole if k % 20 == 0}
