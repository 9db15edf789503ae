"""Hashed word shingles of a text, vectorised over all its words."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stream(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + _U(seed)) * _U(0x9E3779B97F4A7C15))


_BYTE = _stream(256, 1 << 20) | _U(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(text: bytes, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash, start, size) of every word (run of bytes other than ASCII white space) of a
    UTF-8 text, with ``fold`` A-Z lower-cased: a sum over bytes of byte value times a value of
    its place."""
    x = np.frombuffer(text, np.uint8)
    if fold:
        x = _LOWER[x]
    at = np.flatnonzero(~_BLANK[x])
    if not len(at):
        return np.zeros(0, np.uint64), at, at
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    size = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, size)
    value = _BYTE[x[at]] * _stream(int(size.max()), 7)[place]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64)), at[first], size


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text with A-Z lower-cased."""
    return words(text)[0]


def shingle_set(text: bytes, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the text's ``n``-word shingles; with fewer words the whole
    sequence is one shingle; without words the set is empty."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = mix(h * _U(0x9E3779B97F4A7C15) + w[i:len(w) - k + 1 + i])
    return np.unique(h)
