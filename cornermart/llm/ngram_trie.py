"""A trie of word pairs and triples in Elias-Fano levels, with quantised smoothed probabilities.

Words are known by the first 36 bits of their hash. Level by level the trie holds
- the words themselves, whose places number them,
- for each word its successors, as place of the word times the number of words plus the successor,
- the contexts of two words, likewise, and
- the successors of each such context. They are counted from the context's pointer, and each is
  written as its place among the successors of the context's last word: far smaller numbers, found
  by a successor search relative to the context.
The pointers rise, as the levels do, and lie in Elias-Fano sequences too.

A successor with count c in a context of count C has the share (c - DISCOUNT) / C, rounded down to a
power of 2 ** (-1 / 16) and held as its exponent. What the rounded shares leave of 1 is the weight of
the shorter context, rounded down likewise but finer: probabilities add up to 1, less 0.04 % at most.
"""

from __future__ import annotations

import mmap
import os
from collections.abc import Callable

import numpy as np

from .elias_fano import EliasFano

DISCOUNT = 0.75
FINENESS, FINER = 16, 2048  # codes for each halving of a share, and of a weight
ABSENT = 0  # the code of nothing
TOP = 65535


def coded(share: np.ndarray, fineness: int) -> np.ndarray:
    """One more than the exponent of the power at or next below each share."""
    with np.errstate(divide="ignore"):
        exponent = np.ceil(-np.log2(share) * fineness - 1e-9)
    return np.where(exponent < TOP, exponent + 1, ABSENT).astype(np.uint16)


def decoded(code: np.ndarray, fineness: int) -> np.ndarray:
    return np.where(code == ABSENT, 0.0, np.exp2((code.astype(float) - 1) / -fineness))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, without repeats; by sorting, which is faster here than hashing."""
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=-1))]


def placed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the place of each key among them."""
    n = len(keys)
    bits = n.bit_length()
    if int(keys.max(initial=0)).bit_length() + bits < 64:  # key and number fit into one
        both = keys << bits
        both |= np.arange(n)
        both.sort()
        keys = both >> bits
        both &= (1 << bits) - 1
        order = both
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    new = np.diff(keys, prepend=-1) > 0
    place = np.empty(n, np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return keys[new], place


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts; only those counted at all."""
    key, count = np.concatenate([np.empty(0, np.int64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
    key, count = key[count > 0], count[count > 0]
    bits = int(count.max(initial=0)).bit_length()
    if int(key.max(initial=0)).bit_length() + bits < 64:  # both fit into one number: sorted without an order, which is faster
        key <<= bits
        key |= count
        key.sort()
        count = key & ((1 << bits) - 1)
        key >>= bits
    else:
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _shares(context: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the shares in each numbered context, and what is left to the shorter one."""
    total = np.bincount(context, count, n)
    code = coded((count - DISCOUNT) / total[context], FINENESS)
    return code, coded(np.maximum(1 - np.bincount(context, decoded(code, FINENESS), n), 0), FINER)


class Trie:
    """Levels over the words, pairs and triples that one shard owns."""

    SEQUENCES = ("words", "pair_contexts", "pairs", "roots", "successors", "pointers", "contexts", "bases", "triples")
    TABLES = ("pair_code", "pair_rest", "triple_code", "triple_rest")

    def __init__(self, sequences: dict[str, EliasFano], tables: dict[str, np.ndarray]):
        self.__dict__.update(sequences)
        self.__dict__.update(tables)

    @classmethod
    def build(cls, words: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], triples: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Trie:
        """From sorted words, (pair keys, counts) and (context keys, successors, counts) of triples.

        A pair's key is place of the first * number of words + place of the second, a context's
        place of its last word * number of words + place of the one before. Triples are sorted by
        context, then successor.
        """
        m = max(len(words), 1)
        key, count = pairs
        of, context = np.unique(key // m, return_inverse=True)
        pair_code, pair_rest = _shares(context, count, len(of))
        context_keys, successor, n = triples
        known, number = np.unique(context_keys, return_inverse=True)
        roots, root = np.unique(known // m, return_inverse=True)
        triple_code, triple_rest = _shares(number, n, len(known))
        after = distinct(root[number] * m + successor)  # distinct successors of each last word
        degree = np.bincount(after // m, minlength=len(roots)).astype(np.int64)
        pointers = np.concatenate([[0], np.cumsum(degree)])
        bases = np.concatenate([[0], np.cumsum(degree[root])])
        place = np.searchsorted(after, root[number] * m + successor) - pointers[root[number]]
        sequences = {
            "words": words, "pair_contexts": of, "pairs": context * m + key % m, "roots": roots, "successors": after,
            "pointers": pointers, "contexts": root * m + known % m, "bases": bases, "triples": bases[number] + place,
        }
        tables = {"pair_code": pair_code, "pair_rest": pair_rest, "triple_code": triple_code, "triple_rest": triple_rest}
        return cls({name: EliasFano.of(v) for name, v in sequences.items()}, tables)

    def mapped(self) -> Trie:
        """The same trie, read from a memory map of its file; the file has no name and no folder."""
        parts = [a for name in self.SEQUENCES for a in getattr(self, name).arrays()] + [getattr(self, t) for t in self.TABLES]
        handle = os.memfd_create("trie")
        try:
            for a in parts:
                self._write(handle, a)
            size = max(os.fstat(handle).st_size, 1)
            os.ftruncate(handle, size)
            memory = mmap.mmap(handle, size, prot=mmap.PROT_READ)
        finally:
            os.close(handle)
        at, views = 0, []
        for a in parts:
            views.append(np.frombuffer(memory, a.dtype, len(a), at))
            at += -(-a.nbytes // 8) * 8
        sequences = {name: EliasFano.from_arrays(*views[4 * k : 4 * k + 4]) for k, name in enumerate(self.SEQUENCES)}
        return Trie(sequences, dict(zip(self.TABLES, views[4 * len(self.SEQUENCES) :], strict=True)))

    @staticmethod
    def _write(handle: int, a: np.ndarray) -> None:
        view = memoryview(a.tobytes() + b"\0" * (-a.nbytes % 8))
        while view:
            view = view[os.write(handle, view) :]

    def pairs_of(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Codes of the pairs of numbered words; a word that isn't known has -1. Equal ``u`` are neighbours."""
        return _at(self.pair_code, self._relative(self.pairs, _grouped_find(self.pair_contexts, u), w), ABSENT)

    def pair_left(self, u: np.ndarray) -> np.ndarray:
        """Code of the weight that each word leaves to its successors' own frequency; 1 if it isn't known."""
        return _at(self.pair_rest, _grouped_find(self.pair_contexts, u), coded(np.ones(1), FINER)[0])

    def triples_of(self, u: np.ndarray, t: np.ndarray, successors: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of what contexts leave, and of their successors.

        Contexts have last word ``u``, equal ones neighbours, ``t`` before it, and each a number of
        successors, which stand in ``w`` one context after the other.
        """
        root = _grouped_find(self.roots, u)
        context = self._relative(self.contexts, root, t)
        left = _at(self.triple_rest, context, coded(np.ones(1), FINER)[0])
        known = np.flatnonzero(context >= 0)
        shift = np.zeros(len(context), np.int64)  # from a place among all successors to one in the context
        shift[known] = self.bases[context[known]] - _grouped(lambda r: self.pointers[r], root[known])
        place = self._relative(self.successors, np.repeat(np.where(context >= 0, root, -1), successors), w)
        some = np.flatnonzero(place >= 0)
        at = np.full(len(w), -1, np.int64)
        at[some] = self.triples.find(np.repeat(shift, successors)[some] + place[some])
        return left, _at(self.triple_code, at, ABSENT)

    def _relative(self, level: EliasFano, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        out = np.full(len(parent), -1, np.int64)
        some = np.flatnonzero((parent >= 0) & (child >= 0))
        out[some] = level.find(parent[some] * max(self.words.size, 1) + child[some])
        return out


def _grouped(of: Callable[[np.ndarray], np.ndarray], values: np.ndarray) -> np.ndarray:
    """A function of values among which equal ones are neighbours, called with each of these once."""
    first = np.flatnonzero(np.diff(values, prepend=-2))
    return np.repeat(of(values[first]), np.diff(first, append=len(values)))


def _grouped_find(level: EliasFano, words: np.ndarray) -> np.ndarray:
    return _grouped(lambda w: np.where(w >= 0, level.find(np.maximum(w, 0)), -1), words)


def _at(table: np.ndarray, at: np.ndarray, otherwise: int) -> np.ndarray:
    out = np.full(len(at), otherwise, np.uint16)
    some = np.flatnonzero(at >= 0)
    out[some] = table[at[some]]
    return out
