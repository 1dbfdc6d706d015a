"""Words, word hashes and word n-gram hashes of texts, vectorised."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers that tell the places in an n-gram apart, and the constants
# of the splitmix64 finaliser (fixed values).
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(own: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, in order of place."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out += h[k:len(h) - n + 1 + k] * PLACES[k]
    return mix(out)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles; a text of fewer
    words is one shingle, one without words has none."""
    h = word_hashes(words(text))
    return np.unique(ngram_hashes(h, min(n, len(h)))) if len(h) else h
