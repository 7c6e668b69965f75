"""Decontamination against a search over every window."""

import random
import re
from collections import Counter

from censuskit.llm import decontam
from tests.conftest import SF01


def words(text):
    return re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def similar(a, b, n):
    ca, cb = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (a, b))
    weight = lambda s: sum(len(w.encode()) for w in s)
    low = sum(weight(s) * min(ca[s], cb[s]) for s in ca)
    high = sum(weight(s) * max(ca[s], cb[s]) for s in {*ca, *cb})
    return low / high if high else 0.0


def brute(docs, items, least=0.8):
    """Best window over all of them, without fingerprints."""
    out = {}
    listed = [(i, words(t)) for i, t in items]
    runs = lambda x, n: {tuple(x[s : s + n]) for s in range(len(x) - n + 1)}
    known = [(i, v, min(5, len(v)), runs(v, min(5, len(v)))) for i, v in listed if v]
    for d, text in docs:
        w = words(text)
        own = {n: runs(w, n) for n in {n for _, _, n, _ in known}}
        for i, v, n, has in known:
            size = min(len(v), len(w))
            if size < n or not own[n] & has:  # nothing shared: similarity zero
                continue
            score, start = max(((similar(w[s : s + size], v, n), -s) for s in range(len(w) - size + 1)), default=(0, 0))
            if score >= least:
                out[d, i] = (score, -start)
    return out


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioustnrl") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(30, 90)))) for i in range(15)] + [(100, "only three words"), (101, ""), (102, None), (103, "!?")]
    docs = []
    for d in range(60):
        body = [word() for _ in range(rng.randint(0, 150))]
        if d % 3 == 0:
            item = items[rng.randrange(15)][1].split()
            for _ in range(d % 4):  # near copies: some words changed
                item[rng.randrange(len(item))] = word()
            at = rng.randint(0, len(body))
            body[at:at] = item
        docs.append((d, " ".join(body)))
    docs += [(200, items[3][1].upper().replace(" ", ", ")), (201, None), (202, ""), (203, "x Only, THREE words!"), (204, " ".join(items[4][1].split()[:-1])), (205, items[5][1] * 2 + " " + items[6][1]), (206, "w " * 50_000)]
    return docs, items


def test_equals_every_window(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 15
    for size in (decontam.ITEM_BYTES, 600):  # one block of items, and several
        got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontam.find(df, bench, item_bytes=size).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)


def test_keep_clean(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs] + [(None, None, None)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    dirty = {d for d, _ in brute(docs, items)}
    for size in (decontam.ITEM_BYTES, 600):
        got = decontam.keep_clean(df, bench, item_bytes=size)
        assert got.schema == df.schema
        assert sorted(str(r.doc_id) for r in got.collect()) == sorted([str(d) for d, _ in docs if d not in dirty] + ["None"])


def test_items_are_prepared_by_tasks_and_bounded_by_blocks(spark):
    """Ten thousand items, a third of them alike, in many blocks."""
    items = [(i, " ".join(f"w{(i if i % 3 else 0) * 7 + j}" for j in range(i % 9))) for i in range(10_000)]
    df = spark.createDataFrame(items, "item_id long, text string").repartition(6)
    sources = decontam.item_blocks(df, "item_id", "text", 5, 1 << 16)
    blocks = next(sources)
    groups = [g for shared in sources for g in shared.value]
    assert blocks > 5 and sorted(int(i) for g in groups for i in g.ids) == [i for i, t in items if t]
    sizes = {int(i): int(n) for g in groups for i, n in zip(g.ids, g.sizes)}
    assert all(sizes[i] == i % 9 for i in sizes)


def test_all_within_the_radius_are_found(spark):
    """The multi-index loses nothing: like comparing all fingerprints."""
    docs, items = corpus()
    table = decontam.prepared(spark.createDataFrame(items, "i long, t string"), "i", "t", decontam.SHINGLE).toArrow()
    for group in decontam.make_items(table):
        for radius in (3, 18):
            index = group.index(radius)
            assert sum(width for _, width, _ in index) == 64 and len(index) == radius + 1


def test_planted_passages(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.find(df, bench).collect()}
    docs, items = ([tuple(r) for r in x.select(*c).collect()] for x, c in ((df, ("doc_id", "text")), (bench, ("item_id", "text"))))
    whole = {(d, i) for d, t in docs for i, v in items if len(words(v)) >= 5 and v in (t or "")}
    assert whole and whole <= got
    assert decontam.find(df.limit(0), bench).count() == 0 and decontam.find(df, bench.limit(0)).count() == 0
