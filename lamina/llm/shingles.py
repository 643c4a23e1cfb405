"""Word shingles as 64-bit hashes: lower-case A-Z, words without space and 0x09-0x0D, five words in a row."""

from __future__ import annotations

import numpy as np
import xxhash

from lamina.llm.common import windows

WORDS = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word. To hash a word takes less than to look its hash up."""
    parts = []
    for part in windows(data, 1 << 20):
        words = part.lower().split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_hashes(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """A hash for each place where ``k`` words stand in a row; with fewer words, one for the whole sequence;
    without words, none."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    h = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        h = h * _MULTIPLIER + words[i : n - width + 1 + i]
    return mix(h + np.uint64(width))


def shingle_set(data: bytes, k: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(shingle_hashes(word_hashes(data), k))
