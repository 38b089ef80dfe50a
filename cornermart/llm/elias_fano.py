"""Elias-Fano sequences: sorted numbers in about three bits each beside their low bits.

The low bits lie packed; the high parts are a bit per number, and a zero for each step of the high
part. Counts of ones before each 64-bit word of it answer access and successor search for many
numbers at once. All parts are plain arrays, so that a sequence can be read from a memory map.
"""

from __future__ import annotations

import numpy as np

U1, BYTES, TOPS = np.uint64(1), np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: For each byte and n, the place of its bit number n.
BIT_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64).ravel()


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits, one after the other, as bytes; a word of zeros follows."""
    at = np.arange(len(values)) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    values = values.astype(np.uint64)
    out = np.zeros((len(values) * bits >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(values << shift, first)
    over = np.flatnonzero(shift > 64 - bits)  # at most one number of a word reaches into the next
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out.view(np.uint8)


def _select(words: np.ndarray, k: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Place, in the whole, of the bit with number ``inside`` in word ``k``."""
    x, r = words[k], inside.astype(np.uint64)
    sums = x - ((x >> U1) & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + ((sums >> np.uint64(2)) & np.uint64(0x3333333333333333))
    sums = ((sums + (sums >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * BYTES  # ones up to each byte
    shift = np.bitwise_count((((r * BYTES) | TOPS) - sums) & TOPS).astype(np.uint64) << np.uint64(3)
    r -= ((sums << np.uint64(8)) >> shift) & np.uint64(255)
    byte = (x >> shift) & np.uint64(255)
    return (k << 6) + shift.astype(np.int64) + BIT_IN_BYTE[(byte << np.uint64(3) | r).astype(np.int64)]


class EliasFano:
    """A sorted sequence of numbers below 2**62."""

    def __init__(self, low: np.ndarray, high: np.ndarray, before: np.ndarray, size: int, bits: int):
        self.low, self.high, self.before, self.size, self.bits = low, high, before, size, bits
        self.zeros_before = (np.arange(len(before), dtype=np.int64) << 6) - before
        # every byte offset of the packed numbers, read as a 64-bit number
        self.windows = np.ndarray((max(len(low) - 7, 0),), "<u8", low, strides=(1,)) if bits else None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max((top // n).bit_length() - 2, 0) if n else 0  # one less than the shortest: fewer numbers share a high part
        low = _packed(values & ((1 << bits) - 1), bits) if bits else np.zeros(0, np.uint8)
        place = (values >> bits) + np.arange(n)
        length = n + (top >> bits) + 2  # a zero follows the last
        flags = np.zeros(-(-length // 64) * 64, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view("<u8")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(low, high, before, n, bits)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.before, np.array([self.size, self.bits])]

    @classmethod
    def from_arrays(cls, low: np.ndarray, high: np.ndarray, before: np.ndarray, meta: np.ndarray) -> EliasFano:
        return cls(low, high, before, int(meta[0]), int(meta[1]))

    def _ones(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, k, "right") - 1
        return _select(self.high, word, k - self.before[word])

    def _zeros(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros_before, k, "right") - 1
        return _select(~self.high, word, k - self.zeros_before[word])

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(k), np.int64)
        at = k * self.bits
        return (self.windows[at >> 3] >> (at & 7).astype(np.uint64)).astype(np.int64) & ((1 << self.bits) - 1)

    def __getitem__(self, k: np.ndarray) -> np.ndarray:
        return ((self._ones(k) - k) << self.bits) | self._low(k)

    def _cluster(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which values have a high part that occurs at all, from and to where it does, and their low bits."""
        steps = int((len(self.high) << 6) - self.before[-1]) if self.size else 0  # zeros there are
        high = values >> self.bits
        near = np.flatnonzero(high < steps)
        high, low = high[near], values[near] & ((1 << self.bits) - 1)
        at = np.zeros(len(near), np.int64)  # of the first bit for this high part
        later = high > 0
        at[later] = self._zeros(high[later] - 1) + 1
        word, off = at >> 6, (at & 63).astype(np.uint64)
        following = self.high[np.minimum(word + 1, len(self.high) - 1)] << U1 << (np.uint64(63) - off)
        ahead = (self.high[word] >> off) | following
        first = at - high
        end = first + np.bitwise_count(ahead & ~(ahead + U1))  # ones that follow
        many = np.flatnonzero(end - first == 64)
        end[many] = self._zeros(high[many]) - high[many]
        return near, first, end, low

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first number at or above each of the values; the size if there is none."""
        values = np.asarray(values, np.int64)
        found = np.full(len(values), self.size, np.int64)
        near, first, end, low = self._cluster(values)
        live = np.flatnonzero(first < end)
        while len(live):  # a cluster is sorted by its low bits
            middle = (first[live] + end[live]) >> 1
            less = self._low(middle) < low[live]
            first[live[less]] = middle[less] + 1
            end[live[~less]] = middle[~less]
            live = live[first[live] < end[live]]
        found[near] = np.minimum(first, self.size)
        return found

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 for those that aren't there; of equal numbers any one."""
        values = np.asarray(values, np.int64)
        out = np.full(len(values), -1, np.int64)
        near, first, end, low = self._cluster(values)
        some = np.flatnonzero(first < end)
        near, first, end, low = near[some], first[some], end[some], low[some]
        live = np.flatnonzero(end - first > 1)
        a, b, wanted = first[live], end[live], low[live]
        while len(live):
            middle = (a + b) >> 1
            up = self._low(middle) <= wanted
            a, b = np.where(up, middle, a), np.where(up, b, middle)
            done = b - a == 1
            first[live[done]] = a[done]
            live, a, b, wanted = live[~done], a[~done], b[~done], wanted[~done]
        hit = self._low(first) == low
        out[near[hit]] = first[hit]
        return out
