"""Vectorised work on the UTF-8 bytes of one text: word bounds, rolling hashes.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. Hashes are polynomial sums modulo
2**64 over a fixed random byte table, so equal byte strings have equal hashes on
every executor and in every run.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def to_bytes(text) -> np.ndarray:
    """The UTF-8 bytes of a text (null: empty)."""
    return np.frombuffer(text.encode("utf-8", "surrogatepass") if text else b"", np.uint8)


def powers(n: int, kind: str = "up") -> np.ndarray:
    """BASE**i (or its inverse) modulo 2**64 for i < n, grown on demand."""
    have = _POWERS[kind]
    if len(have) < n:
        base = BASE if kind == "up" else BASE_INVERSE
        grown = np.full(max(n, 2 * len(have), 1 << 14), base, np.uint64)
        grown[0] = 1
        _POWERS[kind] = have = np.cumprod(grown, dtype=np.uint64)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """out[i] = sum of code(byte j) * BASE**j over j < i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(len(data)), out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xCA9B0C7EBA1DA115)
    return h ^ (h >> np.uint64(32))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words of ``data``."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edge = np.flatnonzero(np.diff(inside))
    return edge[::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``, independent of where it stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = prefix_hash(data)
    return mix((sums[ends] - sums[starts]) * powers(len(data) + 1, "down")[starts])


_WINDOW_CODE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive words (none: fewer than k words)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * _WINDOW_CODE[0]
    for j in range(1, k):
        total = total + words[j : j + n] * _WINDOW_CODE[j]
    return mix(total)
