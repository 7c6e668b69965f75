"""SimHash groups against all pairs, and planted near copies."""

import random
import re

import numpy as np
import xxhash

from censuskit.llm import simhash
from censuskit.llm.components import components, contract


def brute_print(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, radius):
    """Smallest key reachable, by a search over all pairs."""
    out, keys = {}, sorted(prints, key=lambda k: (k is None, k))
    for k in keys:
        if k in out:
            continue
        stack = [k]
        out[k] = k
        while stack:
            a = stack.pop()
            for b in keys:
                if b not in out and bin(prints[a] ^ prints[b]).count("1") <= radius:
                    out[b] = k
                    stack.append(b)
    return out


def corpus(rng):
    base = [" ".join(rng.choice("ka lo mi nu re so ta vu".split()) + rng.choice("abcdef") for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts = list(base)
    for t in base:
        w = t.split()
        for _ in range(4):
            v = list(w)
            v[rng.randrange(len(v))] = "edit" + str(rng.randrange(50))
            texts.append(" ".join(v))
    return texts + ["", None, " \t\r\n\x0b\x0c", "one", "One", "TWO words", "É x y z", "w " * 20_000, base[0], base[0], base[0].upper()]


def test_groups_equal_all_pairs(spark):
    texts = corpus(random.Random(3))
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, bits string, node int")
    want = {i: brute_print(t) for i, t in enumerate(texts)}
    groups = brute_groups(want, 3)
    for rows in (simhash.TRIE_ROWS, 2):  # whole tries, and pairs of subtries
        got = simhash.near_duplicates(df, trie_rows=rows).collect()
        assert {r.doc_id: r.fingerprint for r in got} == {k: f"{v:016x}" for k, v in want.items()}
        assert {r.doc_id: r.component_id for r in got} == groups


def test_dense_bits_and_wide_radius(spark):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centres for _ in range(60)}
    values |= {1 << 63, (1 << 63) | 1, 0, 7, (1 << 64) - 1}
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    df = spark.createDataFrame([(s,) for s in signed], "bits long")
    for radius, rows in ((3, 10), (3, 20_000), (1, 5), (7, 20_000)):
        got = {r.node: r.root for r in components(simhash.trie_links(df, radius, rows)).collect()}
        groups = brute_groups(signed, radius)
        assert {s: got.get(s, s) for s in signed} == groups


def test_null_keys_repeats_and_empty_table(spark):
    rows = [(None, "a b c"), (None, "a b c"), (4, "a b c"), (4, "a b c"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [("4", 4), ("4", 4), ("9", 9), ("None", 4), ("None", 4)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_contract_and_chains(spark):
    node, root = contract(np.array([5, 4, 3, 9]), np.array([4, 3, 2, 8]))
    assert dict(zip(node.tolist(), root.tolist())) == {3: 2, 4: 2, 5: 2, 9: 8}
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (7, 7), (None, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "node long, root long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100}


def test_representatives(spark):
    texts = corpus(random.Random(4))
    rows = [(i, t, "z", 1) for i, t in enumerate(texts)] + [(3, texts[3], "z", 1), (3, "quite another text here", "y", 2)] + [(None, "nobody's own words", "n", 0)] * 3 + [(None, texts[0], "n", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bits string, root int")
    prints = {n: brute_print(r[1]) for n, r in enumerate(rows)}
    want = brute_groups(prints, 3)
    members = {}
    for n, g in want.items():
        members.setdefault(g, []).append(rows[n])
    got = simhash.representatives(df)
    assert got.schema == df.schema
    smallest = sorted(str(min((r[0] for r in m if r[0] is not None), default=None)) for m in members.values())
    assert sorted(str(r.doc_id) for r in got.collect()) == smallest
    assert all(tuple(r) in rows for r in got.collect())
    assert simhash.representatives(df.limit(0)).count() == 0
