"""Words of a text as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words that a worker remembers before it starts anew, about 6 MB.
_CACHE_WORDS = 40_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    """A hash for each word; A-Z in lower case unless told otherwise. ``bytes.split``
    cuts at the six ASCII space characters, ``bytes.lower`` touches A-Z only."""
    words = text.lower().split() if lower else text.split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


_BASE = 0x9E3779B97F4A7C15
_powers = {_BASE: np.ones(1, np.uint64), pow(_BASE, -1, 2**64): np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1), modulo 2^64."""
    if len(_powers[base]) < n:
        steps = np.full(max(1 << 14, 2 * n), np.uint64(base))
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of ``size`` consecutive items, which are well-mixed hashes
    themselves: differences of prefix sums of h[j] * base^j, brought to one power."""
    n = len(h)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * _power(_BASE, n), out=sums[1:])
    out = (sums[size:] - sums[:-size]) * _power(pow(_BASE, -1, 2**64), n - size + 1)
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def byte_windows(data: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of ``size`` consecutive bytes."""
    return window_hashes((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), size)
