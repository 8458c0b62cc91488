"""Byte-level text kernels shared by the Arrow-batched operators.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  UTF-8 continuation and lead
bytes never fall in that set, so splitting bytes equals splitting code points.
All hashing is vectorised: a prefix sum of ``byte * base**i`` modulo 2**64 gives the
polynomial hash of any slice in O(1), because an odd base is invertible.
"""

from __future__ import annotations

import numpy as np

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
BLANK_BYTES = b" \t\n\x0b\x0c\r"

_IS_BLANK = np.zeros(256, dtype=np.int8)
_IS_BLANK[list(BLANK_BYTES)] = 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_BYTES = Powers(0x9E3779B97F4A7C15)
_WORDS = Powers(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit lanes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    edge = np.ones(len(buf) + 2, dtype=np.int8)
    edge[1:-1] = _IS_BLANK[buf]
    step = np.diff(edge)
    return np.flatnonzero(step == -1), np.flatnonzero(step == 1)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    up, down = _BYTES.upto(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every run of ``width`` word hashes (none if there are fewer words)."""
    n = len(words)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    up, down = _WORDS.upto(n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * up, out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * down[: n - width + 1])
