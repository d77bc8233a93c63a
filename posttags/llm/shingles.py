"""Words and word shingles as 64-bit numbers, for tasks that compare whole texts."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_ODD_A, _ODD_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
# A word's number is a polynomial in BASE, modulo 2**64, over a drawn value for each byte.
_BASE = 0xC2B2AE3D27D4EB4F
_FACTORS = (_BASE, pow(_BASE, -1, 1 << 64))
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of BASE and of its inverse

# Blanks of plain ASCII: space, tab, line and page breaks.
ASCII_BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers_to(n: int) -> list[np.ndarray]:
    """The first powers of BASE and of its inverse, kept by the worker and grown by doubling."""
    while len(_powers[0]) < n:
        for side, factor in enumerate(_FACTORS):
            have = _powers[side]
            step = np.uint64(pow(factor, len(have), 1 << 64))
            _powers[side] = np.concatenate([have, have * step])
    return _powers


def word_hashes(data: bytes, blanks: np.ndarray = ASCII_BLANKS) -> np.ndarray:
    """A number for each run of bytes that are not ``blanks``, equal for equal runs."""
    codes = np.frombuffer(data, np.uint8)
    edges = np.diff(blanks[codes].astype(np.int8), prepend=1, append=1)
    start, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    power, inverse = _powers_to(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_VALUES[codes] * power[: len(codes)], out=sums[1:])
    words = (sums[end] - sums[start]) * inverse[start]
    words ^= words >> np.uint64(32)
    words *= _ODD_A
    return words ^ (words >> np.uint64(29))


def words_of(text: str) -> np.ndarray:
    """Words with A-Z lower-cased, cut at ASCII blanks; both work on bytes alone."""
    return word_hashes(text.encode().lower())


def ngrams(words: np.ndarray, width: int) -> np.ndarray:
    """One number for each run of ``width`` hashed words."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = words[:n] * _ODD_A
    for at in range(1, width):
        total ^= total >> np.uint64(29)
        total = total * _ODD_B + words[at : at + n]
    total ^= total >> np.uint64(32)
    return total * _ODD_A


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Distinct shingles, sorted. Fewer words than ``width`` make one shingle, none make none."""
    words = words_of(text)
    if not len(words):
        return words
    if len(words) < width:  # the length keeps it apart from any longer shingle's words
        words = np.concatenate([words, np.full(width, len(words), np.uint64)])
        return ngrams(words, len(words))
    return np.unique(ngrams(words, width))
