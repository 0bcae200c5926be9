"""Sets of word shingles as 64-bit hashes, and their min-hash signatures."""

from __future__ import annotations

import hashlib

import numpy as np

# ASCII white space parts words; everything else belongs to them.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2**64; at least ``n`` of each."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        for_base, for_inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, for_base)]))
        _INVERSES = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, for_inverse)]))
    return _POWERS, _INVERSES


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word, A-Z in lower case: a polynomial of its bytes, then mixed."""
    text = np.frombuffer(data.translate(_LOWER), np.uint8)
    if not len(text):
        return np.empty(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACE[text], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    powers, inverses = _powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[: len(text)], out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * inverses[starts]
    return mixed(hashes + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; with fewer words that of all of them."""
    words = word_hashes(data)
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(width, len(words))):
        rolled = rolled * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : j + n]
    return np.unique(mixed(rolled + np.uint64(min(width, len(words)))))


def set_id(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


class MinHash:
    """Signatures of ``size`` 16-bit prints of the minima of as many random orders."""

    def __init__(self, size: int, seed: int = 17):
        random = np.random.default_rng(seed)
        self.factors = random.integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = random.integers(0, 1 << 63, size, np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.uint64(_MASK))
        for part in range(0, len(hashes), 1024):
            own = hashes[part : part + 1024]
            values = self.factors[:, None] * own[None, :] + self.offsets[:, None]
            np.minimum(least, values.min(axis=1), out=least)
        return (mixed(least) >> np.uint64(48)).astype(np.uint16)
