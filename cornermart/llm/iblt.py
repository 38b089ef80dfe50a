"""Invertible Bloom lookup sketches of many key sets at once, in numpy.

A key goes into one cell of each of three subtables. A cell has the number of its keys, their xor and
the xor of their check hashes. The difference of two sketches holds the keys of one set only; cells
with a single key give it away, it is taken out of its other cells, and so on (peeling).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SUBTABLES = 3
U = np.uint64


def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), another for each salt."""
    x = keys ^ U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _check(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 97) >> U(32)).astype(np.uint32)


@dataclass
class Sketches:
    """One row of cells per set."""

    count: np.ndarray
    key: np.ndarray
    check: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray], cells: int) -> Sketches:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        keys = np.concatenate([*sets, np.empty(0, U)])
        made = cls(*(np.zeros((len(sets), cells), t) for t in (np.int32, U, np.uint32)))
        made.put(owner, keys, np.ones(len(keys), np.int32))
        return made

    def put(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
        cells = self.count.shape[1]
        part, check = cells // SUBTABLES, _check(keys)
        for t in range(SUBTABLES):
            at = owner * cells + t * part + (_mix(keys, t + 8 * cells) % U(part)).astype(np.int64)
            np.add.at(self.count.reshape(-1), at, sign)
            np.bitwise_xor.at(self.key.reshape(-1), at, keys)
            np.bitwise_xor.at(self.check.reshape(-1), at, check)

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.key ^ other.key, self.check ^ other.check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, key) of the keys recovered from differences, and the rows that came out empty."""
        rows, keys = [], []
        while True:
            single = (np.abs(self.count) == 1) & (_check(self.key.ravel()).reshape(self.key.shape) == self.check)
            row, cell = np.nonzero(single)
            if not len(row):
                break
            key, sign = self.key[row, cell], self.count[row, cell]
            order = np.lexsort((key, row))
            row, key, sign = row[order], key[order], sign[order]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            row, key, sign = row[first], key[first], sign[first]
            self.put(row, key, -sign)
            rows.append(row), keys.append(key)
        empty = ~(self.count.any(1) | self.key.any(1) | self.check.any(1))
        return np.concatenate([*rows, np.empty(0, np.int64)]), np.concatenate([*keys, np.empty(0, U)]), empty


def differing(a: list[np.ndarray], b: list[np.ndarray], cells: int) -> np.ndarray:
    """Number of keys in one set of each pair only; pairs that don't peel get twice the cells."""
    found = np.zeros(len(a), np.int64)
    left = np.arange(len(a))
    while len(left):
        diff = Sketches.of([a[k] for k in left], cells).minus(Sketches.of([b[k] for k in left], cells))
        row, _, empty = diff.peel()
        found[left] = np.bincount(row, minlength=len(left))
        left, cells = left[~empty], 2 * cells
    return found
