"""Binary-fuse filters of 64-bit keys: static, three cells a key, one byte a cell, no false negatives.

A key's three cells lie in neighbouring segments. Cells that one key alone has
are peeled, all of a round at once, until none is left; the keys then get their
cells in reverse order, so that the three bytes of each give its fingerprint.
About 1.13 bytes a key; one in 256 other keys passes.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np

from corpusloom.llm.arrays import mix

TRIES = 100


@dataclass
class Fuse:
    seed: int
    segment: int
    cells: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be one of the filter's."""
        if not len(self.cells):
            return np.zeros(len(keys), bool)
        hashed = _hash(keys, self.seed)
        at = _cells(hashed, self.segment, len(self.cells))
        return self.cells[at[0]] ^ self.cells[at[1]] ^ self.cells[at[2]] == _fingerprint(hashed)


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.astype(np.uint64) + mix(np.array([seed + 1], np.uint64)))


def _fingerprint(hashed: np.ndarray) -> np.ndarray:
    return (hashed ^ (hashed >> np.uint64(32))).astype(np.uint8)


def _cells(hashed: np.ndarray, segment: int, size: int) -> np.ndarray:
    """The three cells of each hash, in three segments that follow each other."""
    first = ((hashed >> np.uint64(32)) * np.uint64(size - 2 * segment)) >> np.uint64(32)
    low = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((hashed >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * segment)) ^ (hashed & low)
    return np.stack([first, second, third]).astype(np.int64)


def _shape(n: int) -> tuple[int, int]:
    """Cells of a segment (a power of two) and of all."""
    segment = min(1 << int(log(max(n, 2)) / log(3.33) + 2.25), 1 << 18)
    spare = max(1.125, 0.875 + 0.25 * log(1e6) / log(max(n, 2)))
    segments = max(1, -(-round(n * spare) // segment) - 2)
    return segment, (segments + 2) * segment


def build(keys: np.ndarray) -> Fuse:
    """The filter of the keys; repeats count once."""
    keys = np.unique(keys.astype(np.uint64))
    if not len(keys):
        return Fuse(0, 1, np.zeros(0, np.uint8))
    segment, size = _shape(len(keys))
    for seed in range(TRIES):
        hashed = _hash(keys, seed)
        at = _cells(hashed, segment, size)
        rounds = _peel(at, size)
        if rounds is not None:
            break
    else:
        raise RuntimeError(f"no filter of {len(keys)} keys in {TRIES} tries")
    cells, marks = np.zeros(size, np.uint8), _fingerprint(hashed)
    for own, which in reversed(rounds):
        # a cell peeled in a round belongs to one key alone, so those of the round don't touch each other
        x, y, z = at[:, which]
        cells[own] = marks[which] ^ cells[x] ^ cells[y] ^ cells[z]
    return Fuse(seed, segment, cells)


def _peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (cell, key): cells that only that key was left to have; None if keys remain."""
    n = at.shape[1]
    count = np.bincount(at.ravel(), minlength=size)
    held = np.zeros(size, np.int64)  # the exclusive or of the keys of a cell: where one is left, its number
    for row in at:
        np.bitwise_xor.at(held, row, np.arange(n))
    rounds, left = [], n
    open_cells = np.flatnonzero(count == 1)
    while len(open_cells):
        which, first = np.unique(held[open_cells], return_index=True)
        rounds.append((open_cells[first], which))
        left -= len(which)
        touched = at[:, which]
        np.subtract.at(count, touched.ravel(), 1)
        for row in touched:
            np.bitwise_xor.at(held, row, which)
        touched = np.unique(touched)
        open_cells = touched[count[touched] == 1]
    return None if left else rounds
