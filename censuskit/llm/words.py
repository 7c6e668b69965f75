"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

#: Byte classes: white space 0, letters (and all bytes beyond ASCII) 1,
#: digits 2, other signs 3.
CLASSES = np.array([
    0 if b in (9, 10, 11, 12, 13, 32) else 1 if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else 2 if 48 <= b <= 57 else 3 for b in range(256)
], np.uint8)
#: White space apart, everything else one class.
SOLID = (CLASSES > 0).astype(np.uint8)
#: A-Z to a-z.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_M = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_TABLE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int):
    """Powers of an odd number and of its inverse modulo 2**64, 0 to n."""
    if len(_POWERS[0]) <= n:
        for k, base in enumerate((_M, pow(_M, -1, 1 << 64))):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each longest run of bytes of one class in a row;
    class 0 separates."""
    kind = classes[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    edge[len(data)] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] > 0
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``spans`` takes the hash of any stretch of bytes."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=out[1:])
    return out


def sums(values: np.ndarray) -> np.ndarray:
    """Sums from which ``spans`` takes the hash of any stretch of 64-bit values."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes [start, end): equal bytes, equal hashes."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def every(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all stretches of ``width`` bytes, like ``spans``."""
    _, down = _powers(len(sums))
    n = max(0, len(sums) - width)
    return mix((sums[width:] - sums[:n]) * down[:n])
