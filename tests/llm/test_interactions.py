"""The audit of filter interactions against a walk over single documents."""

import itertools
import random
import re
from collections import Counter

import duckdb
import pytest

from censuskit.llm import interactions
from tests.conftest import SF01

DOCS = "doc_id long, text string, source string, part string, mask int"
LABELS = "doc_id long, quality int, toxic int, n long"


def failing(doc_id, text, texts):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    text = text or ""
    smaller = any(x is not None and (doc_id is None or x < doc_id) for x in texts[text])
    tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text)), smaller]
    return {x for x, fails in zip("ABCDE", tests) if fails}


def brute(docs, labels):
    """Document by document, order by order."""
    texts = {}
    for doc_id, text, *_ in docs:
        texts.setdefault(text or "", []).append(doc_id)
    good, toxic = ({d for d, *marks in labels if d is not None and marks[at] == 1} for at in (0, 1))
    out = []
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], failing(d[0], d[1], texts)) for d in docs if (d[2] or "") == part]
        shapley, rows = Counter(), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                kept = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                rows.append((part, order, step, len(kept), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), x))
                left = kept
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out)


def documents(n=400, seed=3):
    """Documents that fail any set of filters, copies, null and empty values, one hot source."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        words = [rng.choice("abcdefgh") if rng.random() < 0.3 else f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 3, 49, 50, 60, 80]))]
        text = rng.choice([" ", "\n", "  "]).join(words) + rng.choice(["", "", "#", "ABCDEFGHIJKLMNOPQRST" * 3])
        made.append([i, text, rng.choice(["hot", "hot", "b", "", None]), "x", 1])
    for row in rng.sample(made, 150):
        row[1] = rng.choice(made)[1]
    made[5][1] = made[6][1] = None
    made[7][1] = "A" + " long word" * 200_000
    return [tuple(r) for r in [*made, *made[10:20], (None, made[30][1], "b", "x", 1), (None, "alone", "b", "x", 1), (None, "alone", "b", "x", 1), (3, "another text", "c", "x", 1)]]


def marks(n=400):
    return [(i, i % 2, i % 3 // 2, 1) for i in range(0, n, 3)] + [(0, 1, 1, 1), (9, None, None, 1), (None, 1, 1, 1), (10**9, 1, 1, 1)]


def test_equals_brute_force(spark):
    docs, labels = documents(), marks()
    got = interactions.document_audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(tuple(r) for r in got) == brute(docs, labels)
    assert all(sum(r[c] for r in got) > 0 for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame(documents()[:40], DOCS), spark.createDataFrame(marks(), LABELS)
    assert interactions.document_audit(docs.limit(0), labels).count() == 0
    unlabelled = interactions.document_audit(docs, labels.limit(0)).collect()
    assert unlabelled and {(r.good_lost, r.toxic_lost) for r in unlabelled} == {(0, 0)}


@pytest.mark.parametrize("filters", [1, 2, 3, 5, 6])
def test_every_order_once_and_right(filters):
    rng = random.Random(filters)
    counts = {m: (rng.randrange(9), rng.randrange(3)) for m in range(1 << filters) if rng.random() < 0.7}
    t = interactions.orders(filters, counts, 2)
    assert sorted(map(tuple, t["order"].tolist())) == sorted(itertools.permutations(range(filters)))
    for order, steps, kept, removed in zip(t["order"].tolist(), t["filter"].tolist(), t["kept"].tolist(), t["removed"].tolist()):
        assert steps == order
        seen = 0
        for f, k, r in zip(order, kept, removed):
            assert r == [sum(c[w] for m, c in counts.items() if not m & seen and m >> f & 1) for w in (0, 1)]
            seen |= 1 << f
            assert k == [sum(c[w] for m, c in counts.items() if not m & seen) for w in (0, 1)]


def test_equal_subdiagrams_are_one_node_and_swaps_keep_counts():
    diagram = interactions.Diagram(4, {0: (5,), 15: (2,)}, 1)
    assert [len(x) for x in diagram.levels] == [1, 2, 3, 3] and diagram.root.counts == (7,)
    upper = [id(n) for n in diagram.levels[1]]
    diagram.swap(1)
    assert diagram.order == [0, 2, 1, 3] and [id(n) for n in diagram.levels[1]] == upper
    assert all(n.counts == tuple(map(sum, zip(n.passes.counts, n.fails.counts))) for level in diagram.levels for n in level)


def test_filters_are_bounded(spark):
    df = spark.createDataFrame([("p", 0, 1)], "part string, mask int, documents long")
    for letters in ("", "ABCDEFGH", ["AB"]):
        with pytest.raises(ValueError):
            interactions.audit(df, letters, [])
    assert interactions.audit(df, "A", []).collect()[0].asDict() == {"part": "p", "filter_order": "A", "step": 1, "kept": 1, "removed": 0, "redundant": 0, "unique_fails": 0, "shapley": 0}


def test_equals_sql(spark):
    read = lambda n: spark.read.parquet(f"{SF01}/{n}.parquet")
    con = duckdb.connect()
    for n in ("documents", "labels"):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF01}/{n}.parquet'")
    got = interactions.document_audit(read("documents"), read("labels")).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.sql(interactions.AUDIT_SQL).fetchall())
