"""Conversation repair against all edits of short conversations, and a plain
dynamic programme over whole ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from censuskit.llm import conversations as C
from tests.conftest import SF01

ROWS = "conv_id long, turn long, role string, text string, fault int, n string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "ok")
        seen.add((role, text))
    return out


def programme(rows, marks):
    """Least (cost, audit) of each state, with the rows made, row by row."""
    follow = {0: ["user"], 1: ["user"], 2: ["assistant"], 3: ["user"]}
    state_of = {"user": 2, "assistant": 3}

    def inserted(best):
        for _ in range(3):
            for p, (cost, audit, made) in list(best.items()):
                for r in follow[p]:
                    new = (cost + 3, audit + "I", made + [(r, "")])
                    if state_of[r] not in best or new[:2] < best[state_of[r]][:2]:
                        best[state_of[r]] = new
        return best

    best = {0: (0, "", [])}
    for (_, _, role, text), mark in zip(rows, marks):
        new = {}

        def reach(q, found):
            if q not in new or found[:2] < new[q][:2]:
                new[q] = found

        for p, (cost, audit, made) in inserted(dict(best)).items():
            reach(p, (cost + 4, audit + "D", made))
            if mark in ("ok", "truncated"):
                more = 3 * (mark == "truncated")
                reach(state_of[follow[p][0]], (cost + 3 + more, audit + "R", made + [(follow[p][0], text)]))
                if role[:1] == "s" and p == 0:
                    reach(1, (cost + more, audit + "K", made + [(role, text)]))
                for r in follow[p]:
                    if role[:1] == r[0]:
                        reach(state_of[r], (cost + more, audit + "K", made + [(role, text)]))
        best = new
    if not rows:
        return 0, "", []
    return min((v for p, v in inserted(dict(best)).items() if p in (0, 3)), key=lambda v: v[:2])


def brute(ids, rows):
    """Per conversation: the contract's columns."""
    by = {c: [] for c in ids}
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        marks = faults(own)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, made = programme(own, marks)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def checked(spark, rows, **report):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS)
    got = C.report(df, **report).collect()
    assert len(got) == len({r[0] for r in rows})
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert {r[0]: tuple(r)[1:] for r in got} == brute({r[0] for r in rows}, plain)
    return got


def table(seed=0, n=120, long=150):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 8]) if conv else long):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ärger"])
            rows.append((conv if conv != 7 else None, rng.choice([turn, turn, turn, 3, None]), role, rng.choice(["Yes.", "No", "No ", "  \n", "", None, "Why?\t", "é!", f"own {rng.random()}", "."])))
    rows += [(n, 5, "user", "again.")] * 40 + [(n, 5, "user", "")] * 9 + [(n + 1, t, "user", "same.") for t in range(60)] + [(n + 2, 10**12, "assistant", "word " * 200_000 + ".")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [1, 3, 4_096])
@pytest.mark.parametrize("partitions", ["1", "23"])
def test_equals_the_programme(spark, monkeypatch, piece, partitions):
    monkeypatch.setattr(C, "PIECE_ROWS", piece)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)  # conversations cross ranges
    try:
        got = checked(spark, table(piece, n=40, long=90))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert {c for r in got for c in r.audit} == set("DIKR")


def test_all_edits_of_short_conversations():
    """No edits at all are cheaper, or as cheap and before in ASCII."""
    rng = random.Random(4)
    for _ in range(150):
        rows = [(0, rng.choice("suax"), "", 1, rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 5))]
        best = None
        for letters in itertools.product("DKR", repeat=len(rows)):
            for lead in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
                state, cost, audit = 0, 0, ""
                for row, letter, ins in zip([*rows, None], [*letters, ""], lead):
                    for _ in ins:
                        state, cost = C.AFTER[C.NEXT[state]], cost + 3
                    audit += ins + letter
                    if row is None or letter == "D":
                        cost += 4 * (letter == "D")
                        continue
                    to = C.keeps(state, row[1]) if letter == "K" else C.AFTER[C.NEXT[state]]
                    if to is None or row[4] >= C.BLANK:
                        break
                    state, cost = to, cost + 3 * (letter == "R") + 3 * (row[4] == C.CUT_OFF)
                else:
                    if state in (0, 3) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
        assert "".join(C.edits_of(rows)) == best[1]


def test_products_of_pieces_lead_to_the_same_states():
    rng = random.Random(9)
    for _ in range(60):
        elements = [C.row_element(rng.choice("suax"), 1 + (f == 3) * rng.randrange(3), f) for f in rng.choices(range(4), k=rng.randrange(1, 40))]
        at = C.states(elements, 0, C.FINISH)
        cuts = sorted({0, len(elements), *rng.choices(range(len(elements)), k=3)})
        pieces = [C.as_element(C.product(elements[a:b])) for a, b in zip(cuts, cuts[1:])]
        assert C.states(pieces, 0, C.FINISH) == [at[c] for c in cuts]
        whole = C.as_element(C.product([C.as_element(C.product([p])) for p in pieces]))
        assert C.states([whole], 0, C.FINISH) == [0, at[-1]]


def test_repaired_rows_read_as_they_should(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_ROWS", 4)
    rows = table(2, n=30)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS)
    got = C.repair(df).collect()
    assert sum(r.n for r in got) == len(rows) and {r.fault for r in got} == {"sound", "truncated", "blank", "duplicate"}
    by, audits = defaultdict(list), {r.conv_id: (r.audit, r.repaired_sha256) for r in C.report(df).collect()}
    for r in sorted(got, key=lambda r: (r.part, r.seq)):
        by[r.conv_id].append(r)
    assert by.keys() == audits.keys()
    for conv, own in by.items():
        made = [x for r in own for x in r.repaired]
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in made))
        assert audits[conv] == ("".join(r.edits for r in own), hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in made).encode()).hexdigest())


def test_query_damage_and_lost_conversations(spark):
    df = spark.read.parquet(f"{SF01}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    rows += [(None, t, r, x) for t, r, x in [(None, None, None), (1, "user", "Hi."), (2, "assistant", "Ho")]]
    lost = next(c for c in range(10**6, 10**7) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone."))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r)[1:] for r in C.report(C.damaged(df), df).collect()}
    assert got == brute({r[0] for r in rows}, damage(rows))
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert all(sum(r[i] for r in got.values()) > 0 for i in range(6))


def test_empty_table(spark):
    df = spark.createDataFrame([], ROWS)
    assert C.report(df).count() == 0 and C.repair(df).count() == 0 and C.damaged(df).count() == 0
    ids = spark.createDataFrame([(3,)], "conv_id long")
    assert C.report(df, ids).collect()[0].audit == ""


def test_equals_sql(spark):
    """Also where keys, turns, roles and texts are null."""
    import duckdb

    rows = [(c, t, r, x) for c, t, r, x in table(6, n=60) if c != 60]  # 60 repeats a turn: its rows' order is not the query's
    rows = list({(r[0], r[1]): r for r in rows}.values())
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    want = con.sql(C.REPORT_SQL).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in C.report(C.damaged(df), df).collect())
