"""Word shingles of a text as 64-bit hashes, and least hashes of their sets."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
# An odd factor that mixes 64 bits, and the odd factors of the 128 hash functions.
MIX = np.uint64(0x9E3779B97F4A7C15)
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, 128, np.uint64) | np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def shingles(text: bytes | None, shingle: int) -> np.ndarray:
    """The set of a text's word shingles as sorted 64-bit hashes.

    ASCII capitals count as small letters. A text of fewer words has its whole word sequence as its only
    shingle; a null or blank text has none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, SEED) for x in words], np.uint64)
    width = min(shingle, len(words))
    size = len(words) - width + 1
    joined = np.zeros(size, np.uint64)
    for at in range(width):
        joined = mixed(joined * MIX + hashes[at : at + size])
    return np.unique(joined)


def least_hashes(found: np.ndarray) -> np.ndarray:
    """The least value of each of the 128 hash functions over a set that is not empty."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        np.minimum(least, np.multiply.outer(FACTORS, found[at : at + 1024]).min(axis=1), out=least)
    return least
