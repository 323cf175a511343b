"""Words, and word shingles, as numbers."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd factors, one for each place of a word in a shingle, and those of the final mixing (fixed values of splitmix64).
PLACES = np.array([2 * xxhash.xxh64_intdigest(f"place {k}") % 2**64 + 1 for k in range(64)], dtype=np.uint64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def split(text: str | None, lower: bool = False) -> list[bytes]:
    """The runs of bytes other than space and 0x09-0x0D, which is what ``bytes.split`` parts at; A-Z lowered on request."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class WordHashes:
    """64-bit hashes of words. None is remembered: looking a word up takes longer than hashing it, and memory besides."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words; of the whole sequence, if it is shorter; none without words."""
    width = min(width, len(hashes))
    if not width:
        return hashes
    total = np.full(len(hashes) - width + 1, width, dtype=np.uint64) * PLACES[63]
    for k in range(width):
        total += hashes[k : len(hashes) - width + 1 + k] * PLACES[k]
    return mix(total)
