"""Byte-level BPE encoding and decoding.

Encoding follows the rule that a token sequence is the BPE encoding of its
bytes exactly when every two neighbours are: so the merges compile into a
finite-state transducer. After each byte its state holds the hypotheses still
alive, each the token before a boundary and the bytes read since (a node of the
trie of tokens), and nothing of what came before: exactly one token can end at
each byte, the transducer names it, and the tokens of any prefix follow from it
backwards. So states merge whatever led to them. A token leaves the transducer
as soon as all hypotheses go back to it, which is after a bounded lookahead.
States and transitions are determinised when first needed and kept.

Decoding feeds token bytes to an incremental UTF-8 state machine that holds
back an incomplete character, at most three bytes.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

#: States kept per worker before the tables start afresh; words, and runs between
#: spaces, remembered of those met once and of those met again.
MAX_STATES = 150_000
MAX_WORDS = 150_000
#: Longer words are not remembered.
LONGEST_WORD = 64
#: Bytes of one match between looks at which tokens are certain.
LOOK = 1_024
#: Tokens decoded at a time.
DECODE_TOKENS = 65_536


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


#: A token before a boundary is kept in the lowest bits of a hypothesis; all of them: none.
_BITS = 20
_NONE = (1 << _BITS) - 1
#: White space, and a space that touches another or a text's end: no place to cut.
_SPACE = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD_SPACE = f" [{_SPACE}]|[{_SPACE}] |\\A | \\z"
#: Bytes of text that are cut into runs together.
RUN_BYTES = 8 << 20


class _Memo(dict):
    """Ids of strings that came up twice, as bytes of 32-bit numbers, and in
    ``once`` of those that came up once; each starts afresh when it is full.
    What is not remembered is worked out in a lookup."""

    def __init__(self, encode, most: int):
        self.encode, self.most, self.once = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        found = self.once.pop(word, None)
        if found is None:
            found, here = self.encode(word), self.once
        else:
            here = self
        if len(word) <= LONGEST_WORD:
            if len(here) >= self.most:
                here.clear()
            here[word] = found
        return found


class BpeTransducer:
    """Encoder for one rank table; ``pattern`` splits text before the merges.

    ``spaces`` says that no match runs over a space that stands between two
    characters other than white space: then texts are cut before such spaces
    first, and each distinct run is split and encoded once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, max_words: int = MAX_WORDS, spaces: bool = False):
        if max(ranks.values()) >= _NONE:
            raise ValueError(f"ranks must be below {_NONE}")
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.max_states, self.spaces = max_states, spaces
        # The trie of tokens: children by (node, byte); a node's token, and whether longer ones go on.
        self.child: dict[int, int] = {}
        self.at, self.depth, self.longer = [-1], [0], [True]
        for token, rank in ranks.items():
            node = 0
            for n, byte in enumerate(token, 1):
                self.longer[node] = True
                key, node = node << 8 | byte, self.child.get(node << 8 | byte, -1)
                if node < 0:
                    node = self.child[key] = len(self.at)
                    self.at.append(-1)
                    self.depth.append(n)
                    self.longer.append(False)
            self.at[node] = rank
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        self.words = _Memo(self._encode_word, max_words)
        self.runs = _Memo(self._encode_run, max_words)
        self.reset()

    def reset(self) -> None:
        self.pairs.clear()
        start = (_NONE,)
        self.states: dict[tuple[int, ...], int] = {start: 0}
        self.alive: list[tuple[int, ...]] = [start]
        self.steps: dict[int, int] = {}

    def last_merge(self, token: int) -> tuple[int, int]:
        """The two tokens that the last merge of a token's bytes joins."""
        found = self.halves.get(token)
        if found is None:
            parts = [self.token[token][i : i + 1] for i in range(len(self.token[token]))]
            while len(parts) > 2:
                ranks = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
                i = ranks.index(min(ranks))
                if ranks[i] >= token:
                    raise ValueError(f"token {token} is not reached by merges")
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            found = self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return found

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in just these two."""
        # Undo the merges of both, latest first; no merge over the boundary
        # may come before the one undone. Of equal ranks the leftmost is first.
        limit = 1 << 60
        while True:
            over = self.ranks.get(self.token[left] + self.token[right])
            if over is not None and over < limit:
                return False
            a, b = self.length[left] > 1, self.length[right] > 1
            if not a and not b:
                return True
            if a and (left > right or not b):
                limit, left = left, self.last_merge(left)[1]
            else:
                limit, right = right + 1, self.last_merge(right)[0]

    def _step(self, state: int, byte: int) -> int:
        """A new transition: the next state and the token that ends here, in one
        number. Hypotheses come with the longest token first."""
        alive, done = [], -1
        for hypothesis in self.alive[state]:
            node = self.child.get((hypothesis >> _BITS) << 8 | byte)
            if node is None:
                continue
            before = hypothesis & _NONE
            if done < 0 and (token := self.at[node]) >= 0:
                fits = before == _NONE or self.pairs.get(before << _BITS | token)
                if fits is None:
                    fits = self.pairs[before << _BITS | token] = self.neighbours(before, token)
                if fits:
                    done = token
            if self.longer[node]:
                alive.append(node << _BITS | before)
        if done < 0:
            raise ValueError(f"byte {byte} is not a token")
        alive.append(done)
        found = self.steps[state << 8 | byte] = self._state(tuple(alive)) << _BITS | done
        return found

    def _state(self, alive: tuple[int, ...]) -> int:
        state = self.states.get(alive)
        if state is None:
            state = self.states[alive] = len(self.alive)
            self.alive.append(alive)
        return state

    def _back(self, last: list[int], end: int) -> list[int]:
        """The tokens of a prefix, from the tokens that end at its bytes."""
        out = []
        while end:
            out.append(last[end - 1])
            end -= self.length[last[end - 1]]
        return out[::-1]

    def encode_piece(self, piece: bytes) -> Iterator[int]:
        """Token ids of one match of the pattern, as they become certain."""
        if len(self.alive) > self.max_states:
            self.reset()
        state, last = 0, []
        for n, byte in enumerate(piece, 1):
            found = self.steps.get(state << 8 | byte)
            if found is None:
                if len(self.alive) > 2 * self.max_states:  # one piece alone may fill the tables
                    here = self.alive[state]
                    self.reset()
                    state = self._state(here)
                found = self._step(state, byte)
            state = found >> _BITS
            last.append(found & _NONE)
            if n % LOOK == 0:
                # Go back from all boundaries to the last that they share.
                ends = {len(last) - self.depth[x >> _BITS] for x in self.alive[state]}
                while len(ends) > 1:
                    end = max(ends)
                    ends.remove(end)
                    ends.add(end - self.length[last[end - 1]])
                sure = ends.pop()
                yield from self._back(last, sure)
                del last[:sure]
        yield from self._back(last, len(last))

    def _encode_word(self, word: str) -> bytes:
        """Ids of one match of the pattern."""
        piece = word.encode()
        if len(piece) > LOOK or len(self.alive) > self.max_states:
            return array("i", self.encode_piece(piece)).tobytes()
        state, last, steps = 0, [], self.steps.get
        for byte in piece:
            found = steps(state << 8 | byte)
            if found is None:
                found = self._step(state, byte)
            state = found >> _BITS
            last.append(found & _NONE)
        return array("i", self._back(last, len(last))).tobytes()

    def _encode_run(self, run: str) -> bytes:
        """Ids of a run that begins with a space left out: one match, or several,
        of which those that begin with a space are runs, too."""
        words = self.split(" " + run)
        if len(words) == 1:
            return self._encode_word(words[0])
        return b"".join([self.runs[x[1:]] if x[0] == " " else self.words[x] for x in words])

    def _ids(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def ids(self, text: str) -> bytes:
        """Token ids of a text as bytes of 32-bit numbers."""
        if not self.spaces:
            return self._ids(text)
        runs = text.split(" ")
        joined = [runs[0]]
        for run in runs[1:]:  # cut only between other characters than white space
            if run and not run[0].isspace() and joined[-1] and not joined[-1][-1].isspace():
                joined.append(run)
            else:
                joined[-1] += " " + run
        return self._ids(joined[0]) + b"".join(map(self.runs.__getitem__, joined[1:]))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.ids(text), np.int32).tolist()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a column of texts without nulls, end to end, and where
        each text's begin (one more than texts). Runs between spaces are told
        apart in the column, and each distinct one is looked up once."""
        odd = pc.match_substring_regex(texts, _ODD_SPACE) if self.spaces else pa.array([True] * len(texts))
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        runs = cut.flatten().dictionary_encode()
        codes = runs.indices.to_numpy().astype(np.int64)
        # A text's first run has no space before it; a text that cannot be cut is one run.
        first = [self.ids(x) if alone else self._ids(x[: x.find(" ")] if " " in x else x) for x, alone in zip(texts.to_pylist(), odd.to_pylist())]
        codes[bounds[:-1]] = len(runs.dictionary) + np.arange(len(texts))
        used = np.zeros(len(runs.dictionary), bool)
        used[codes[codes < len(used)]] = True
        ids = [self.runs[x] if u else b"" for x, u in zip(runs.dictionary.to_pylist(), used.tolist())]
        taken = pa.array(ids + first, pa.large_binary()).take(pa.array(codes))
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
        data = np.frombuffer(taken.buffers()[2], np.uint8) if taken.buffers()[2] is not None else np.zeros(0, np.uint8)
        return data[offsets[0] : offsets[-1]].view(np.int32), (offsets[bounds] - offsets[0]) // 4


class Tokenizer:
    """A rank table and its pattern, to be broadcast. The transducer compiled
    from it stays with it, so the tasks of a worker share what it has learnt."""

    def __init__(self, *parts):
        self.parts, self.compiled = parts, None

    def __getstate__(self):
        return {"parts": self.parts, "compiled": None}

    def machine(self) -> BpeTransducer:
        if self.compiled is None:
            self.compiled = BpeTransducer(*self.parts)
        return self.compiled


class Utf8Machine:
    """Incremental UTF-8 decoding: complete characters come out at once, an
    incomplete last one waits. Malformed bytes become U+FFFD."""

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def _incomplete(data: bytes) -> int:
        """Length of the unfinished character at the end of ``data``."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:  # continuation: its lead lies before
                continue
            need = 2 if 0xC2 <= byte <= 0xDF else 3 if byte & 0xF0 == 0xE0 else 4 if 0xF0 <= byte <= 0xF4 else 1
            if need <= back:
                return 0
            # The second byte of some leads has a narrower range.
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(byte, (0x80, 0xBF))
            return back if back == 1 or low <= data[1 - back] <= high else 0
        return 0

    def feed(self, data: bytes | memoryview) -> str:
        data = self.waiting + bytes(data)
        cut = len(data) - self._incomplete(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def decode_stream(token: dict[int, bytes], ids: Iterable[list[int]]) -> Iterator[str]:
    """Text of token id chunks, chunk by chunk; what is no token is U+FFFD."""
    machine, unknown = Utf8Machine(), "\ufffd".encode()
    for chunk in ids:
        yield machine.feed(b"".join(token.get(i, unknown) for i in chunk))
    yield machine.end()


def steadily(batches: Iterator) -> Iterator:
    """``batches`` with the cycle collector at rest: the tables hold millions of
    small objects, none in a cycle, which it would walk again and again."""
    gc.disable()
    try:
        yield from batches
    finally:
        gc.enable()


def _columns(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text", spaces: bool = False) -> DataFrame:
    """``key`` and ``ids`` (token ids) of every row; a null text is empty and
    has no ids. Rows are independent: repeated rows, null keys and extra
    columns need no care, an empty table gives an empty table; very long texts
    are encoded whole. ``spaces`` is the pattern's (see ``BpeTransducer``)."""
    shared = df.sparkSession.sparkContext.broadcast(Tokenizer(ranks, pattern, MAX_STATES, MAX_WORDS, spaces))

    def run(batches):
        machine = shared.value.machine()
        for batch in steadily(batches):
            for part in slices(batch, "text", RUN_BYTES):
                ids, bounds = machine.encode_column(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))], ["key", "ids"])

    kind = df.schema[key].dataType.simpleString()
    return _columns(df, key, text).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` of token id lists. Null lists count as empty, and an
    id that is null or no token's decodes to U+FFFD, as do bytes that are not
    UTF-8. Rows are independent; other columns are not read; lists of any length
    are decoded ``DECODE_TOKENS`` at a time. No rows, none back."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        token = {r: t for t, r in shared.value.items()}
        for batch in batches:
            texts = []
            for row in batch.column("ids").to_pylist():
                row = row or []
                texts.append("".join(decode_stream(token, (row[i : i + DECODE_TOKENS] for i in range(0, len(row), DECODE_TOKENS)))))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


class _Pieces:
    """The bytes that stand for ids, end to end."""

    def __init__(self, by_id: dict[int, bytes]):
        size = max(by_id) + 1
        self.pieces = pa.array([by_id.get(i) for i in range(size)], pa.binary())

    def of(self, ids: np.ndarray) -> memoryview:
        taken = self.pieces.take(pa.array(ids))
        start, end = np.frombuffer(taken.buffers()[1], np.int32)[[taken.offset, taken.offset + len(taken)]]
        return memoryview(taken.buffers()[2])[start:end]


def roundtrip_digests(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text", max_states: int = MAX_STATES, max_words: int = MAX_WORDS, spaces: bool = False
) -> DataFrame:
    """Encodes every text, decodes its ids, and returns ``key``, ``n_tokens``,
    ``ids_sha256`` (of decimal ids joined by one space) and ``decoded_sha256``
    (of the decoded bytes). One narrow pass without a shuffle; null texts count
    as empty, with no tokens and the digests of nothing. Rows are independent:
    repeated rows, null keys and extra columns need no care, an empty table gives
    an empty table. A very long text is encoded whole, and decoded
    ``DECODE_TOKENS`` at a time. The bounds on states and words trade a worker's
    memory for time; ``spaces`` is the pattern's (see ``BpeTransducer``)."""
    shared = df.sparkSession.sparkContext.broadcast(Tokenizer(ranks, pattern, max_states, max_words, spaces))

    def run(batches):
        machine = shared.value.machine()
        names, tokens = _Pieces({r: b"%d " % r for r in machine.token}), _Pieces(machine.token)
        for batch in steadily(batches):
            for part in slices(batch, "text", RUN_BYTES):
                rows = ([], [], [])
                every, bounds = machine.encode_column(part.column("text"))
                for begin, end in zip(bounds.tolist(), bounds[1:].tolist()):
                    ids = every[begin:end]
                    listed, decoded, utf8 = hashlib.sha256(), hashlib.sha256(), Utf8Machine()
                    for i in range(0, len(ids), DECODE_TOKENS):
                        some = ids[i : i + DECODE_TOKENS]
                        listed.update(names.of(some)[: -1 if i + DECODE_TOKENS >= len(ids) else None])
                        decoded.update(utf8.feed(tokens.of(some)).encode())
                    decoded.update(utf8.end().encode())
                    for values, value in zip(rows, (len(ids), listed.hexdigest(), decoded.hexdigest())):
                        values.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[key].dataType.simpleString()
    return _columns(df, key, text).mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
