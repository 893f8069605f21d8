"""Words and word shingles of whole Arrow columns as 64-bit numbers, without a Python loop
over words.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the SplitMix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64, of an odd base or of its inverse."""
    known = _POWERS.get(inverse)
    if known is None or len(known) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        known = np.ones(1, np.uint64)
        while len(known) < n:
            known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
        _POWERS[inverse] = known
    return known[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """n + 1 sums of (byte + 1) * base^place: differences stand for substrings."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return lower, space


_LOWER, _SPACE = _tables()


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and the n + 1 bounds of the rows in these."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(ends), np.int64)
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = ends[(ends > 0) & (ends < n)]
    first[cuts] = word[cuts]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[cuts - 1] = word[cuts - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = prefix_hashes(_LOWER[data])
    h = (sums[stops] - sums[starts]) * powers(n + 1, True)[starts]
    return mixed(h + (stops - starts).astype(np.uint64)), starts, stops, np.searchsorted(starts, ends)


def shingle_sets(
    data: np.ndarray, ends: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every row in rising order, and the n + 1 bounds of the rows.

    A row with fewer words than ``size`` has one shingle of all of them, one without words
    none.
    """
    h, _, _, bounds = words(data, ends)
    counts = np.diff(bounds)
    whole = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(bounds[:-1], whole) + _places(whole)
    wide = np.repeat(np.minimum(counts, size), whole)
    total = wide.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(size):
        part = h[np.minimum(first + k, max(len(h) - 1, 0))] if len(h) else h
        weight = np.uint64(pow(0xC2B2AE3D27D4EB4F, 2 * k + 1, 1 << 64))
        total = total + np.where(wide > k, part * weight, np.uint64(0))
    total = mixed(total)
    rows = np.concatenate([[0], np.cumsum(whole)])
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        total[a:b].sort()
    new = np.ones(len(total), bool)
    new[1:] = total[1:] != total[:-1]
    new[rows[:-1][whole > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return total[new], kept[rows]


def _places(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. count - 1 for each count."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
