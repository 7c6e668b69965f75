"""Byte-level BPE against the tiktoken library and exact round trips."""

import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from censuskit.llm import bpe

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MACHINE = bpe.BpeTransducer(RANKS, P.PATTERN)
SPACED = bpe.BpeTransducer(RANKS, P.PATTERN, max_states=3_000, max_words=40, spaces=True)

SAMPLES = [
    "", " ", "\n\n  \t", "a", "Hello world's  weird   spacing\r\n", "naïve café 東京 😀🏳️‍🌈", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "<|endoftext|>", "\x1c\x1d\x85 x", "x" * 5000, "ab" * 3000, "  " * 1000 + "z", "1234567890" * 50, "!!??--==" * 40, "I'll we've 'tis",
]


@pytest.mark.parametrize("text", SAMPLES)
def test_same_ids_as_the_library(text):
    assert MACHINE.encode(text) == SPACED.encode(text) == REFERENCE.encode_ordinary(text)


def same_column(machine, texts):
    ids, bounds = machine.encode_column(pa.array(texts, pa.string()))
    assert len(bounds) == len(texts) + 1 and bounds[0] == 0 and bounds[-1] == len(ids)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == REFERENCE.encode_ordinary(text), text


def test_a_column_is_cut_at_single_spaces_only():
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = SAMPLES + [f"a{x} b {x}c{x}{y}d e" for x in spaces for y in ("", " ", "\n")] + [" lead", "trail ", " both ", "one  two", "a b c", "don't we 'll go", "x " * 3000]
    for machine in (SPACED, MACHINE):
        same_column(machine, texts)
        same_column(machine, [])
        same_column(machine, [""])
        ids, bounds = machine.encode_column(pa.array(["zero", *texts, "last"])[1:-1])  # a slice of a column
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [REFERENCE.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ',.\n\t\u00a0\u2003é漢1", max_size=40) | st.text(max_size=20), max_size=6))
def test_same_ids_on_any_column(texts):
    same_column(SPACED, [t.encode("utf-8", "replace").decode() for t in texts])


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(alphabet="abcdelrstin 'AE\n", max_size=80))
def test_same_ids_on_any_text(text):
    assert MACHINE.encode(text) == REFERENCE.encode_ordinary(text)


def test_random_letters_and_small_tables():
    rng = random.Random(5)
    small = bpe.BpeTransducer(RANKS, P.PATTERN, max_states=50, max_words=3)
    for _ in range(200):
        text = "".join(rng.choice("theinroadst ") for _ in range(rng.randint(1, 120)))
        assert small.encode(text) == REFERENCE.encode_ordinary(text)


def test_tokens_leave_before_the_end():
    stream = MACHINE.encode_piece(b"z" * 100_000)
    assert next(stream) == REFERENCE.encode_ordinary("z" * 100_000)[0]


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=30), st.lists(st.integers(1, 4), max_size=30))
def test_utf8_machine_equals_whole_decoding(data, cuts):
    machine, out, at = bpe.Utf8Machine(), "", 0
    for n in cuts:
        out += machine.feed(data[at : at + n])
        assert len(machine.waiting) <= 3
        at += n
    out += machine.feed(data[at:]) + machine.end()
    assert out == data.decode("utf-8", "replace")


def test_dataframe_round_trip(spark):
    rows = [(i, t, "x") for i, t in enumerate(SAMPLES)] + [(99, None, "x"), (None, "null key", "x"), (5, "again", "x"), (5, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ids = bpe.encode(df, RANKS, P.PATTERN)
    back = bpe.decode(ids, RANKS)
    want = sorted((str(k), t or "") for k, t, _ in rows)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == want
    got = bpe.roundtrip_digests(df, RANKS, P.PATTERN, spaces=True).collect()
    assert sorted(map(str, got)) == sorted(map(str, bpe.roundtrip_digests(df, RANKS, P.PATTERN, max_states=100, max_words=5).collect()))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expect = []
    for k, t, _ in rows:
        e = REFERENCE.encode_ordinary(t or "")
        expect.append((str(k), len(e), sha(" ".join(map(str, e))), sha(t or "")))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(expect)
    assert bpe.roundtrip_digests(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_odd_ids_decode_to_the_replacement_character(spark):
    df = spark.createDataFrame([(1, [10**6, None, RANKS[b"a"]]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(df, RANKS).collect()} == {1: "\ufffd\ufffda", 2: "", 3: ""}
