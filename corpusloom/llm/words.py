"""Words, word hashes and runs of words, shared by the operators on near-duplicate and overlapping texts."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
_MASK = (1 << 64) - 1
#: Odd multipliers of the mixing functions (golden-ratio and murmur constants).
GOLDEN, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_CACHE_LIMIT = 500_000


def words(text: str | None) -> list[str]:
    """Maximal runs of letters, digits and underscores of any script, lower-cased; none for null."""
    if not text:
        return []
    if text.isascii():
        return WORD.findall(text.lower())
    return [w.lower() for w in WORD.findall(text)]


class WordHasher:
    """64-bit hashes of words with a bounded cache; equal on every worker."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> np.ndarray:
        known, digest = self._known, xxhash.xxh3_64_intdigest
        if len(known) > _CACHE_LIMIT:
            known.clear()
        out = []
        for w in ws:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """The murmur finaliser over 64-bit integers."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(MIX_A)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(MIX_B)
    return h ^ (h >> np.uint64(33))


def run_hashes(hashed: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive words, in text order; empty if there are fewer words."""
    n = len(hashed) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total = total * np.uint64(GOLDEN) + hashed[i : i + n]
    return mixed(total)


def content_hash(ws: list[str]) -> tuple[int, int]:
    """A 128-bit hash of a word sequence, as two signed longs."""
    both = xxhash.xxh3_128_intdigest(" ".join(ws))
    return signed(both >> 64), signed(both & _MASK)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct hashes; 0 if either is empty."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
