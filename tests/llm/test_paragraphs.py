"""Paragraph deduplication against all pairs of paragraphs and all runs of words."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from censuskit.llm import paragraphs
from censuskit.llm.components import components
from censuskit.llm.queries import QUERIES
from tests.conftest import SF001

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def mark(text):
    """Texts of one key go by their 64-bit hash."""
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def brute(rows, least=0.8, stretch=paragraphs.STRETCH, n=5, passage=paragraphs.PASSAGE):
    """Removed stretches by (key, text), from all pairs and all runs."""
    units, run_at = [], []
    for k, t in set(rows):
        tokens, place = re.findall(WORD, lower(t or "")), 0
        own = (k is None, k or 0, mark(t))
        run_at += [((*own, a), (k, t), tuple(tokens[a : a + passage])) for a in range(len(tokens) - passage + 1)]
        for line in (t or "").split("\n"):
            size = len(re.findall(WORD, line))
            w = tuple(tokens[place : place + size])
            if size >= n:
                shingles = frozenset(w[j : j + n] for j in range(size - n + 1))
                units.append(((*own, place), (k, t), (place, place + size), shingles, w))
            place += size
    units.sort(key=lambda u: u[0])
    parent = list(range(len(units)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    same = {}
    for a, u in enumerate(units):
        parent[a] = find(same.setdefault(u[4], a))
    distinct = {u[4]: a for a, u in reversed(list(enumerate(units)))}  # one paragraph a class
    for a, b in itertools.combinations(sorted(distinct.values()), 2):
        x, y = units[a][3], units[b][3]
        if len(x & y) >= least * len(x | y):
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    keep = {}
    for a, u in enumerate(units):
        keep.setdefault(find(a), u[0])
    gone = {}
    for a, u in enumerate(units):
        if u[0] != keep[find(a)]:
            gone.setdefault(u[1], set()).add(u[2])
    first_run = {}
    for at, doc, w in sorted(run_at, key=lambda x: x[0]):
        if first_run.setdefault(w, at) != at:
            gone.setdefault(doc, set()).add((at[-1], at[-1] + passage))
    out = {}
    for k, t in set(rows):
        merged = []
        for a, b in sorted(gone.get((k, t), ())):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        if found := [(a, b - a) for a, b in merged if b - a >= stretch]:
            out[k, t] = found
    return out


def without(text, removed):
    at = [m.start() for m in re.finditer(WORD, text)] + [len(text)]
    for a, n in reversed(removed):
        text = text[: at[a]] + text[at[a + n] :]
    return text


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, removed string, mark string")
    want = brute(rows)
    got = paragraphs.deduplicate(df, **options).collect()
    assert len(got) == len(rows)
    left = sorted((str(k), str(None if t is None else without(t, want.get((k, t), []))), want.get((k, t), [])) for k, t in rows)
    assert sorted((str(r.doc_id), str(r.kept_text), [(x.start, x.words) for x in r.removed]) for r in got) == left
    return want


def made(seed=2):
    """Documents of invented words with paragraphs that recur, some changed."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(rng.randint(1, 6)))
    base = [[word() for _ in range(rng.randint(4, 90))] for _ in range(25)]
    rows = []
    for d in range(120):
        paras = []
        for _ in range(rng.randint(0, 5)):
            p = list(rng.choice(base)) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 60))]
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = word()
            paras.append(" ".join(p))
        rows.append((d, "\n".join(paras)))
    return rows, base, word


def test_equals_all_pairs(spark, monkeypatch):
    rows, base, _ = made()
    same = " ".join(max(base, key=len)).upper()
    rows += [(300, same + "\n" + same), (301, "\n\n" + same + "\n"), (302, None), (303, ""), (None, same), (None, same), (0, rows[0][1]), (0, "other\n" + same), (304, "a " * 30_000), (305, "a " * 200)]
    for options, bound in (({}, paragraphs.BROADCAST_CLASSES), ({"chunk": 2}, 0)):
        monkeypatch.setattr(paragraphs.similar, "__defaults__", (*paragraphs.similar.__defaults__[:-1], bound))
        assert len(check(spark, rows, **options)) > 40


def test_passages_within_and_across_lines(spark):
    _, _, word = made()
    passage = [word() + word() for _ in range(60)]
    own = lambda n: " ".join(word() + word() + word() for _ in range(n))
    rows = [
        (0, own(40) + " " + " ".join(passage) + " " + own(80)),  # within a paragraph
        (1, own(90) + " " + " ".join(passage) + " " + own(10)),
        (2, own(9) + "\n" + "\n".join(" ".join(passage[i : i + 7]) for i in range(0, 60, 7)) + "\n" + own(30)),  # wrapped into short lines
        (3, own(9) + "\n" + "\n".join(" ".join(passage[i : i + 4]) for i in range(0, 60, 4))),  # lines without a shingle
    ]
    stock = "This nine-word line stands in many of the documents"
    rows += [(10 + i, f"{own(30)}\n{stock}\n{own(25)}") for i in range(30)]
    want = check(spark, rows)
    assert {k for k, _ in want} == {1, 2, 3}  # the first stays, and so do lone stock lines
    assert all(sum(n for _, n in v) >= 40 for v in want.values())


def test_all_of_a_passage_goes(spark):
    """Passages of 50 words and a few more within paragraphs go word for word,
    whatever stands around them; runs of 49 stay; copies and variants of a text in
    other cases go whole."""
    _, _, word = made()
    own = lambda n: " ".join(word() + word() + word() for _ in range(n))
    rows, length = [], {}
    for i in range(60):
        size = 49 + i % 6
        passage = own(size)
        rows += [(2 * i, f"{own(20 + i)} {passage} {own(70)}"), (1000 + i, f"{own(3 * i)} {passage} {own(90)}")]
        length[1000 + i] = size
    rows += [(2000, rows[0][1]), (2001, rows[0][1]), (2002, rows[0][1].upper()), (2003, rows[1][1] + " " + rows[2][1]), (None, rows[4][1])]
    want = check(spark, rows)
    gone = {k: sum(n for _, n in v) for (k, _), v in want.items()}
    assert {k: gone.get(k, 0) for k in length} == {k: n if n >= 50 else 0 for k, n in length.items()}
    assert all(gone[k] == len(t.split()) for k, t in rows[-5:])


def test_every_run_holds_an_anchor():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 49, 50, 51, 200]))) for _ in range(60)] + ["a " * 300]
    for passage in (18, 19, 37, 50, 64):
        row, start, size, cls, anchor, _, _ = paragraphs.units_of(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), 5, passage)
        held = {(r, s): c for r, s, c in zip(row[anchor].tolist(), start[anchor].tolist(), cls[anchor].tolist())}
        classes = {}
        for r, text in enumerate(texts):
            tokens = text.split()
            for a in range(len(tokens) - passage + 1):
                inner = {(s - a, held[r, s]) for s in range(a, a + passage - paragraphs.ANCHOR + 1) if (r, s) in held}
                assert inner
                classes.setdefault(tuple(tokens[a : a + passage]), []).append(inner)
        assert all(set.intersection(*v) for v in classes.values())
        assert all(s + paragraphs.ANCHOR <= len(texts[r].split()) for r, s in held)


def test_documents_and_empty_table(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    got = QUERIES["op6_paragraphs"](spark, SF001).collect()
    assert {r.doc_id: [(x.start, x.words) for x in r.removed] for r in got if r.n_removed} == {k: v for (k, _), v in want.items()}
    assert all(r.n_removed == sum(x.words for x in r.removed) and r.n_spans == len(r.removed) for r in got) and len(got) == df.count()
    assert paragraphs.report(df.limit(0)).count() == 0 and paragraphs.deduplicate(df.limit(0)).count() == 0


def test_bands_reach_the_recall():
    for least, recall in ((0.8, 0.999), (0.9, 0.99), (0.5, 0.95)):
        bands, rows = paragraphs.tune(least, recall)
        assert 1 - (1 - least**rows) ** bands >= recall and bands * rows <= max(paragraphs.HASHES, bands)


def test_values_of_many_classes_are_connected_as_by_all_pairs(spark):
    """Near copies of one list, chains that only a middle joins, and strays, all
    under one band value, dealt out in chunks of three."""
    rng = random.Random(11)
    base = list(range(100))
    sets = []
    for _ in range(40):
        s = set(base)
        for x in rng.sample(base, rng.choice([1, 2, 5, 9])):
            s.discard(x)
            s.add(rng.randrange(1000, 10_000))
        sets.append(sorted(s))
    sets += [list(range(k, k + 60)) for k in range(200, 260, 6)] + [[rng.randrange(10**6) for _ in range(20)] for _ in range(15)]
    rows = [(i, [7, 1000 + i % 3], s) for i, s in enumerate(sets)] + [(0, [7], sets[0]), (500, None, [1])]
    df = spark.createDataFrame(rows, "cls long, bands array<long>, shingles array<int>")
    root = list(range(len(sets)))
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    for a, b in itertools.combinations(range(len(sets)), 2):
        if near(set(sets[a]), set(sets[b])):
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    for chunk in (3, 2000):
        links = paragraphs.similar(df, chunk=chunk).collect()
        assert all(near(set(sets[r.node]), set(sets[r.root])) or root[r.node] == root[r.root] for r in links)
        got = {r.node: r.root for r in components(paragraphs.similar(df, chunk=chunk)).collect()}
        assert [got.get(i, i) for i in range(len(sets))] == root
    assert len(set(root)) > 15 and len(set(root)) < len(sets) - 40
