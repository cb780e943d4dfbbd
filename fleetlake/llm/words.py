"""Words of a text as hashes, and their shingles."""

from __future__ import annotations

import numpy as np
import xxhash

from fleetlake.llm.common import LOWER

#: Words remembered in a worker before it starts afresh.
REMEMBERED = 300_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word to 64-bit hash, filled as words are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_known = _Hashes()


def split_words(text: str) -> list[bytes]:
    """Words of a text, its letters A-Z in lower case; white space is a blank and the characters 9 to 13."""
    return text.encode().translate(LOWER).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_known) > REMEMBERED:
        _known.clear()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters neighbours."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in place; fewer words make one run of all, none make none."""
    n = len(hashes)
    if not n:
        return hashes
    out = np.zeros(max(1, n - size + 1), np.uint64)
    for j in range(min(size, n)):
        out = mixed(out * MULTIPLIER + hashes[j : j + len(out)])
    return out
