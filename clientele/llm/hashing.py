"""Vectorised 64-bit hashes shared by the text operators."""

from __future__ import annotations

import numpy as np

P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_in_place(x: np.ndarray) -> np.ndarray:
    """``mix`` that overwrites a large array, with room for one more of its size."""
    shifted = np.empty_like(x)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        x ^= np.right_shift(x, np.uint64(shift), out=shifted)
        if factor:
            x *= np.uint64(factor)
    return x


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * P)
_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and its inverse modulo 2**64, for i < n."""
    global _up, _down
    if len(_up) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(P), -1, 1 << 64))
        _up, _down = np.full(size, P), np.full(size, inverse)
        for table in (_up, _down):
            table[0] = 1
            np.cumprod(table, out=table)
    return _up[:n], _down[:n]


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word; words are runs of bytes other than ASCII white space."""
    b = np.frombuffer(text, np.uint8)
    gap = (b == 32) | ((b >= 9) & (b <= 13))
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(b))
    terms = BYTES[b] * up
    terms[gap] = 0
    return mix(np.add.reduceat(terms, starts) * down[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; fewer words make one shingle, none make none."""
    n = len(words) - size + 1
    if n <= 0:
        size, n = len(words), 1 if len(words) else 0
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * P + words[k : k + n]
    return mix(out + np.uint64(size))
