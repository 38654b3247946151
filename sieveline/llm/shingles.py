"""Shingle sets and minhash signatures, inside tasks."""

import numpy as np
import xxhash

MASK = (1 << 64) - 1
CACHED_WORDS = 300_000
CACHED_LENGTH = 40
# A block of so many shingles times all permutations stays in a core's cache.
BLOCK = 1_024


class _Hashes(dict):
    """64-bit hashes of words; short words are kept for the next text."""

    def __missing__(self, word):
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


_hashes = _Hashes()


def _mixed(values):
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


# Factors by number and seed; a plain dict, so that the functions here travel with a job by value.
_known = {}


def _factors(n, seed):
    if (n, seed) not in _known:
        with np.errstate(over="ignore"):
            steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)
            _known[n, seed] = _mixed(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _known[n, seed]


def shingle_set(text, size=5):
    """Sorted distinct hashes of the `size`-word shingles of a text in bytes.

    Words are runs without ASCII white space, A-Z lower-cased; fewer words than
    `size` are one shingle, none are no shingle. The whole text counts.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    span = min(n, size)
    factors = _factors(size, 1)
    sums = np.full(n - span + 1, span, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(span):
            sums += hashed[i : n - span + 1 + i] * factors[i]
        return np.unique(_mixed(sums))


def minhashes(shingles, n):
    """The `n` minima of a shingle set under as many permutations, as 16-bit values."""
    factors = _factors(n, 2)
    least = np.full(n, MASK, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), BLOCK):
            block = shingles[start : start + BLOCK]
            np.minimum(least, (factors[:, None] * block[None, :]).min(axis=1), out=least)
        return (_mixed(least) >> np.uint64(48)).astype(np.uint16)


def digest(shingles):
    """128-bit digest of a shingle set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def similar(one, other, percent=75):
    """True if 100 * intersection >= percent * union of two sorted sets."""
    if not len(one) or not len(other):
        return False
    small, large = sorted((len(one), len(other)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)
