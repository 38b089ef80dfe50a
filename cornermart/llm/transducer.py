"""Minimal acyclic transducer: a lexicon of byte strings with outputs, sharing prefixes and suffixes.

Words are added in order; a state is merged with an equal one as soon as no later word can change it,
so the automaton is minimal throughout. Each transition carries the number of words that sort before
those behind it: the sum along a word's path is the word's rank, and ranks index the rows of id
outputs. The arrays lie in one file that readers map into memory.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import numpy as np


@dataclass(frozen=True)
class Transducer:
    """Transitions sorted by (state, byte); state 0 is the start. Row r holds the ids of word r."""

    edge: np.ndarray  # state * 256 + byte
    target: np.ndarray
    output: np.ndarray
    final: np.ndarray  # per state, whether a word ends there
    row: np.ndarray  # where the ids of each word start, and the end
    ids: np.ndarray

    def ranks(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rank of each of the given byte strings in ``data``, -1 for those not in the lexicon."""
        if not len(self.edge):
            return np.full(len(start), -1, np.int64)
        state, rank = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        live = np.arange(len(start))
        for k in range(int(size.max(initial=0))):
            live = live[size[live] > k]
            wanted = state[live] * 256 + data[start[live] + k]
            at = np.minimum(np.searchsorted(self.edge, wanted), len(self.edge) - 1)
            known = self.edge[at] == wanted
            rank[live[~known]] = -1
            live, at = live[known], at[known]
            state[live] = self.target[at]
            rank[live] += self.output[at]
            if not len(live):
                break
        rank[(rank >= 0) & ~self.final[state]] = -1
        return rank


def build(words: list[bytes], ids: list[list[int]]) -> Transducer:
    """The minimal transducer of distinct, non-empty words, given with their ids in any order."""
    order = sorted(range(len(words)), key=words.__getitem__)
    children: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]  # states of the last word
    last = b""

    def merge(down_to: int) -> None:
        """Replaces the states of the last word below a depth by equal ones that exist already."""
        while len(path) - 1 > down_to:
            state = path.pop()
            shape = (final[state], tuple(children[state].items()))
            same = known.setdefault(shape, state)
            children[path[-1]][last[len(path) - 1]] = same

    for k in order:
        word = words[k]
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        merge(shared)
        for byte in word[shared:]:
            children.append({})
            final.append(False)
            children[path[-1]][byte] = len(children) - 1
            path.append(len(children) - 1)
        final[path[-1]] = True
        last = word
    merge(0)

    below: dict[int, int] = {}  # words at or behind a state
    stack = [0]
    while stack:
        state = stack[-1]
        missing = [c for c in children[state].values() if c not in below]
        if missing:
            stack += missing
        else:
            below[state] = final[state] + sum(below[c] for c in children[state].values())
            stack.pop()
    number = {0: 0} | {s: n for n, s in enumerate((s for s in below if s), 1)}
    rows = []
    for state in below:
        before = int(final[state])
        for byte in sorted(children[state]):
            child = children[state][byte]
            rows.append((number[state] * 256 + byte, number[child], before))
            before += below[child]
    rows.sort()
    edge, target, output = np.array(rows, np.int64).reshape(len(rows), 3).T
    ends = np.zeros(len(number), bool)
    for state, n in number.items():
        ends[n] = final[state]
    ordered = [ids[k] for k in order]
    row = np.concatenate([[0], np.cumsum([len(x) for x in ordered], dtype=np.int64)])
    flat = np.array([i for x in ordered for i in x], np.int32)
    return Transducer(edge.copy(), target.astype(np.int32), output.astype(np.int32), ends, row.astype(np.int64), flat)


FIELDS = (("edge", np.int64), ("row", np.int64), ("target", np.int32), ("output", np.int32), ("ids", np.int32), ("final", np.bool_))


def save(t: Transducer, path: Path) -> None:
    """Sizes of the arrays in FIELDS order as 64-bit numbers, then the arrays."""
    parts = [np.ascontiguousarray(getattr(t, name), kind) for name, kind in FIELDS]
    with path.open("wb") as f:
        f.write(np.array([len(p) for p in parts], "<i8").tobytes())
        for part in parts:
            f.write(part.tobytes())


def load(path: Path) -> Transducer:
    """Maps the file; pages are read as they are touched and shared by the workers of a machine."""
    sizes = np.fromfile(path, "<i8", len(FIELDS))
    at, parts = 8 * len(FIELDS), {}
    whole = np.memmap(path, np.uint8, "r")
    for (name, kind), n in zip(FIELDS, sizes, strict=True):
        size = int(n) * np.dtype(kind).itemsize
        parts[name] = whole[at : at + size].view(kind)
        at += size
    return Transducer(**parts)
