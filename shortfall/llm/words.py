"""Hashes of all words of a text, computed over its bytes at once."""

from __future__ import annotations

import numpy as np

#: A random 64-bit value for each place in a word and byte.
TABLE = np.random.default_rng(20240).integers(1, 1 << 63, 256 * 256, np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of bytes other than space and tab to carriage return)."""
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(~IS_SPACE[raw])
    if not len(at):
        return np.empty(0, np.uint64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
    place = at - np.repeat(at[first], np.diff(np.r_[first, len(at)]))
    value = TABLE[((place & 255) << 8) | raw[at]]
    if place.max() > 255:
        value = value * ((place >> 8) * 2 + 1).astype(np.uint64)
    return np.add.reduceat(value, first)
