"""The binary [23, 12, 7] Golay code on numpy arrays."""

from __future__ import annotations

from itertools import combinations

import numpy as np

N, K = 23, 12
#: Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (fixed by the code).
GENERATOR = 0b110001110101


def _remainder(v: int) -> int:
    for bit in range(N - 1, N - K - 1, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - (N - K))
    return v


_SINGLE = np.array([_remainder(1 << i) for i in range(N)], np.uint32)


def _table(bits: range) -> np.ndarray:
    """Syndromes of all patterns of these bits; a syndrome is linear in the word."""
    t = np.zeros(1, np.uint32)
    for b in bits:
        t = np.concatenate([t, t ^ _SINGLE[b]])
    return t


_LOW, _HIGH = _table(range(12)), _table(range(12, N))


def _errors() -> np.ndarray:
    """The code is perfect: each of the 2048 syndromes is that of one pattern of three errors at most."""
    out = np.zeros(1 << (N - K), np.uint32)
    for weight in (1, 2, 3):
        for where in combinations(range(N), weight):
            pattern = sum(1 << i for i in where)
            out[_LOW[pattern & 0xFFF] ^ _HIGH[pattern >> 12]] = pattern
    return out


_ERRORS = _errors()


def index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the only codeword within distance three of each 23-bit word."""
    w = words.astype(np.uint32)
    return (w ^ _ERRORS[_LOW[w & 0xFFF] ^ _HIGH[w >> 12]]) >> (N - K)


def ball(words: np.ndarray, bits: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each word and of its neighbours at distance one in the low ``bits``, and a mask of the first of equal ones.

    Two words that differ in two of these bits at most have a common index: that of the word halfway.
    """
    w = words.astype(np.uint32)[:, None] ^ np.concatenate([[0], 1 << np.arange(bits)]).astype(np.uint32)[None, :]
    found = np.sort(index(w.ravel()).reshape(w.shape), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, fresh
