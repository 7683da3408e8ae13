"""Vectorized polynomial (Rabin-Karp) hashes modulo 2^64 of words and of windows of words."""

from __future__ import annotations

import numpy as np

#: Odd multipliers and the steps of a 64-bit finalizer.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SLICE = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hash_words(data: bytes) -> np.ndarray:
    """A hash of each run of bytes without ASCII white space."""
    codes = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[codes]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(starts, append=len(codes))
    skip = starts[0]
    place = np.arange(skip, len(codes)) - np.repeat(starts, lengths)
    terms = _BYTES[codes[skip:]] * powers(BASE, int(lengths.max()))[place]
    terms[~inside[skip:]] = 0
    return mixed(np.add.reduceat(terms, starts - skip))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text."""
    counts = np.fromiter((len(t.split()) for t in texts), np.int64, len(texts))
    parts, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size > _SLICE:
            parts.append(_hash_words(b" ".join(held)))
            held, size = [], 0
    parts.append(_hash_words(b" ".join(held)))
    return np.concatenate(parts), counts


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of the ``width`` words from each place on; places too near to the end have none."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(BASE, n), dtype=np.uint64, out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * powers(INVERSE, n - width + 1))
