"""Sampled suffixes of texts, chosen by content, and hashes of what they stand for.

Every string of ``WIDTH`` bytes is represented by the k-gram in it whose hash is smallest
(the leftmost of equals): two equal strings are represented at the same distance from
their starts. Neighbouring strings mostly share their k-gram: a run is the strings that
one occurrence of a k-gram represents. So each string of a text is in exactly one run, and
there are about 2 / (WIDTH - GRAM + 2) runs a byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from meterloom.llm.shingles import mixed, powers, prefix_hashes

WIDTH = 100
GRAM = 32
PIECE = 1 << 21
_PLACE_BITS = 22


@dataclass
class Runs:
    """Runs of the rows of a column: row, first and last start in it, hashes."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    whole: np.ndarray


def substring_hashes(
    sums: np.ndarray, starts: np.ndarray, stops: np.ndarray
) -> np.ndarray:
    return mixed((sums[stops] - sums[starts]) * powers(len(sums), True)[starts])


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbouring keys, by blocks of that width."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _owners(sums: np.ndarray, n: int, inverse: np.ndarray) -> np.ndarray:
    """For each string start 0 .. n - WIDTH, where the k-gram that represents it starts."""
    grams_in = WIDTH - GRAM + 1
    out = np.empty(n - WIDTH + 1, np.int64)
    for a in range(0, len(out), PIECE):
        b = min(a + PIECE, len(out)) + grams_in - 1
        h = (sums[a + GRAM : b + GRAM] - sums[a:b]) * inverse[a:b]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys = (h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(
            b - a, dtype=np.uint64
        )
        low = _lowest(keys, grams_in)
        out[a : a + len(low)] = (low & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + a
    return out


def runs_of(data: np.ndarray, ends: np.ndarray) -> tuple[Runs, np.ndarray]:
    """The runs of every row, and the prefix hashes of the bytes. Rows under WIDTH have none."""
    n = len(data)
    sums = prefix_hashes(data)
    none = np.zeros(0, np.int64)
    if n < WIDTH:
        return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64)), sums
    owner = _owners(sums, n, powers(n + 1, True))
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: len(owner)]
    inside = np.arange(len(owner)) + WIDTH <= ends[1:][row]
    new = inside.copy()
    new[1:] &= (owner[1:] != owner[:-1]) | ~inside[:-1]
    new[ends[:-1][np.diff(ends) >= WIDTH]] = True
    over = inside.copy()
    over[:-1] &= new[1:] | ~inside[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(over)
    at = owner[first]
    return (
        Runs(
            row[first],
            first,
            last,
            substring_hashes(sums, at, at + GRAM),
            substring_hashes(sums, first, last + WIDTH),
        ),
        sums,
    )
