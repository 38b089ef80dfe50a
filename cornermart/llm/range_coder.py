"""Adaptive context-mixing range coder for token ids, many blocks in lock step.

A block is coded on its own: its models start empty, and all blocks given at once advance one id per
step, each as one lane of numpy arrays. An id is four digits of four bits, coded from the top. Each
digit has one distribution, the weighted sum of three predictions:

* order 2 and order 1: the id that last followed the two ids before, and the one before, as long as
  its upper digits are those coded so far;
* order 0: a 16-way distribution per upper digits (the last level hashed) that follows the digits seen,
  fast at first and by a 32nd later.

The weights are learnt online, per digit's place and confidences of both foretold ids, by the share
each prediction had in the probability of the digit that came.

The range coder keeps 64 bits and moves 32-bit words; where the range gets too small it is cut at
the word border, so no carry ever runs back.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096  # ids per block
MAX_ID = 1 << 16

U = np.uint64
LEVELS = 4
ROW1, ROW2 = 1 << 12, 1 << 12  # places for order-1 and order-2 predictions of a lane
LAST = 1 << 10  # distributions of the last digit, by a hash of the 12 bits above
NODES = 1 + 16 + 256 + LAST  # 16-way distributions of a lane
FIRST = (0, 1, 17, 273)  # first node of each level
SURE = 7  # highest confidence of a prediction
SCALE = 15  # bits of the 16-way distributions
FLOOR = 32  # least share of a digit in them
TOTAL = 16  # bits of the weights, and of the mixed distribution
LEAST = 256  # weight that a foretold id keeps
LEFT = 1 << (TOTAL - 6)  # least weight of order 0: times FLOOR it keeps every digit possible
MOST = (1 << TOTAL) - LEFT - LEAST  # what both foretold ids' weights go to; one that keeps LEAST may come on top
CONTEXTS = LEVELS * 128  # place of the digit, two confidences, and whether both foretell the same digit
ROW = np.dtype("V32")  # a distribution: a count, then where digits 1 to 15 start, as 16-bit numbers

_j = np.arange(16)
START = (_j * (1 << (SCALE - 4))).astype(np.int16)
TARGET = np.where(_j[None, :] <= _j[:, None], _j * FLOOR, (1 << SCALE) - (16 - _j) * FLOOR).astype(np.int16)
PACE = np.array([1, 2, 2, 3, 3, 3, 3, *[4] * 8, 5], np.int16)  # shift by the times a distribution was used
ABOVE = (_j[None, :] > _j[:, None]).astype(np.uint32)  # by a digit: which digits are above it
TARGET_ROWS, PACE_ROWS = TARGET.view(ROW).ravel(), np.repeat(PACE, 16).view(ROW)  # gathered faster as whole rows
SMALL, WORD, HALF, BTOTAL = U(1 << 32), U(0xFFFFFFFF), U(32), U(TOTAL)


def _first_weights() -> np.ndarray:
    """Weights of order 2 (lower 16 bits) and order 1 before anything is learnt."""
    c2, c1, _ = np.meshgrid(np.arange(8), np.arange(8), np.arange(2), indexing="ij")
    w2 = MOST * c2 // (c2 + 2)
    w1 = (MOST - w2) * c1 // (c1 + 3)
    return np.tile((w2 + (w1 << 16)).astype(np.uint32).ravel(), LEVELS)


WEIGHTS = _first_weights()


class _Digit:
    """The mixed distribution of one digit in every lane."""

    def __init__(self, s: _Lanes, level: int, node: np.ndarray, foretold: _Foretold):
        self.s, self.node = s, node
        shift = 12 - 4 * level
        m = len(node)
        self.d1, self.d2 = (foretold.id1 >> shift) & 15, (foretold.id2 >> shift) & 15
        self.context = s.at_weight[:m] + (foretold.k2 + foretold.k1 + (128 * level))
        self.context += self.d1 == self.d2
        w = s.weight.take(self.context)
        self.w1, self.w2 = (w >> 16).astype(np.int64), (w & 0xFFFF).astype(np.int64)
        self.w0 = (1 << TOTAL) - self.w1 - self.w2
        self.flat = s.split.take(node).view(np.int16)
        self.count = self.flat[::16].copy()
        self.flat[::16] = 0

    def bounds(self, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of the digit's interval, of 2 ** TOTAL."""
        place = self.s.row[: len(digit)] + digit
        begin = self.flat.take(place).astype(np.int64)
        place += 1
        end = self.flat.take(place, mode="clip").astype(np.int64)
        end[digit == 15] = 1 << SCALE
        begin *= self.w0
        begin >>= SCALE
        end *= self.w0
        end >>= SCALE
        self.hit1, self.hit2 = digit == self.d1, digit == self.d2
        self.part1, self.part2 = self.w1 * self.hit1, self.w2 * self.hit2
        end -= begin
        end += self.part1
        end += self.part2
        begin += self.w1 * (digit > self.d1)
        begin += self.w2 * (digit > self.d2)
        self.size = end
        return begin, end

    def find(self, value: np.ndarray) -> np.ndarray:
        """The digit in whose interval ``value`` is."""
        begins = self.flat.reshape(-1, 16).astype(np.uint32)
        begins *= self.w0.astype(np.uint32)[:, None]
        begins >>= np.uint32(SCALE)
        for w, d in ((self.w1, self.d1), (self.w2, self.d2)):
            holds = np.flatnonzero(w)
            begins[holds] += w[holds].astype(np.uint32)[:, None] * ABOVE.take(d[holds], axis=0)
        begun = np.packbits(begins <= value.astype(np.uint32)[:, None]).view(np.uint16)
        return np.bitwise_count(begun).astype(np.int64) - 1

    def learn(self, digit: np.ndarray, foretold: _Foretold) -> None:
        """Weights move by a 16th towards each prediction's share, the distribution towards the digit."""
        s = self.s
        share = MOST / self.size
        new = []
        for w, part in ((self.w1, self.part1), (self.w2, self.part2)):
            moved = (part * share).astype(np.int64)
            moved -= w
            moved >>= 4
            moved += w
            new.append(np.maximum(moved, np.minimum(w, LEAST)))
        s.weight[self.context] = (new[0] << 16) + new[1]
        goal = TARGET_ROWS.take(digit).view(np.int16)
        goal -= self.flat
        goal >>= PACE_ROWS.take(self.count).view(np.int16)
        goal += self.flat
        goal[::16] = np.minimum(self.count + 1, 15)
        s.split[self.node] = goal.view(ROW)
        foretold.k1 *= self.hit1
        foretold.k2 *= self.hit2


class _Foretold:
    """The ids that order 1 and order 2 foretell, and their confidences while they hold."""

    def __init__(self, s: _Lanes, m: int):
        mixed = s.p1[:m] * 40503
        self.i1 = s.at1[:m] + ((mixed >> 4) & (ROW1 - 1))
        mixed += s.p2[:m] * 60493
        self.i2 = s.at2[:m] + ((mixed >> 3) & (ROW2 - 1))
        self.e1, self.e2 = s.last1.take(self.i1), s.last2.take(self.i2)
        self.id1, self.id2 = self.e1 & 0xFFFF, self.e2 & 0xFFFF
        self.k1, self.k2 = (self.e1 >> 16) << 1, (self.e2 >> 16) << 4


class _Lanes:
    """Model and coder state of all lanes; lanes are ordered by falling length."""

    def __init__(self, lengths: np.ndarray):
        n = len(lengths)
        self.lengths = lengths
        self.last1 = np.zeros(n * ROW1, np.int32)  # id + 65,536 * confidence
        self.last2 = np.zeros(n * ROW2, np.int32)
        self.weight = np.tile(WEIGHTS, n)
        self.split = np.tile(START, n * NODES).view(ROW)
        self.lane = lane = np.arange(n)
        self.row = 16 * lane  # place of each lane's distribution among those gathered for a digit
        self.at1, self.at2, self.at_weight, self.at_node = lane * ROW1, lane * ROW2, lane * CONTEXTS, lane * NODES
        self.p1, self.p2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.low, self.range = np.zeros(n, U), np.full(n, ~U(0))

    def active(self, t: int) -> int:
        return int(np.searchsorted(-self.lengths, -t, "left"))

    def node(self, m: int, level: int, above: np.ndarray) -> np.ndarray:
        """Place of the order-0 distribution by the digits above."""
        if level == LEVELS - 1:
            above = (above ^ (above >> 7)) & (LAST - 1)
        return self.at_node[:m] + above + FIRST[level]

    def learn(self, m: int, x: np.ndarray, f: _Foretold) -> None:
        """Right predictions gain confidence; a wrong one loses half of it, and gives way at the lowest."""
        for table, at, e, known in ((self.last1, f.i1, f.e1, f.id1), (self.last2, f.i2, f.e2, f.id2)):
            sure = e >> 16
            right = (x == known) & (sure > 0)
            kept = np.where(right, np.minimum(sure + 1, SURE), sure >> 1)
            table[at] = np.where(kept > 0, known | (kept << 16), x | 65536)
        self.p2[:m] = self.p1[:m]
        self.p1[:m] = x


def _cut(low: np.ndarray, rng: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and range of lanes whose range is small, the range ending at the word border at most."""
    a, r = low[small], rng[small]
    crosses = ((a ^ (a + r)) >> HALF) != 0
    return a, np.where(crosses, (~a + U(1)) & WORD, r)


def encode(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The 32-bit words of each block of at most BLOCK ids below MAX_ID."""
    if not blocks:
        return []
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    lengths = np.array([len(blocks[k]) for k in order])
    s = _Lanes(lengths)
    n, longest = len(blocks), int(lengths[0])
    ids = np.zeros((longest, n), np.int32)
    for lane, k in enumerate(order):
        ids[: lengths[lane], lane] = blocks[k]
    out, used = np.zeros((n, 2 * longest + 8), np.uint32), np.zeros(n, np.int64)
    for t in range(longest):
        m = s.active(t)
        x = ids[t, :m].astype(np.int64)
        f = _Foretold(s, m)
        low, rng = s.low[:m], s.range[:m]
        for level in range(LEVELS):
            at = _Digit(s, level, s.node(m, level, x >> (16 - 4 * level)), f)
            digit = (x >> (12 - 4 * level)) & 15
            begin, size = at.bounds(digit)
            rng >>= BTOTAL
            low += rng * begin.view(U)
            rng *= size.view(U)
            at.learn(digit, f)
            if level & 1:
                small = np.flatnonzero(rng < SMALL)
                if len(small):
                    a, r = _cut(low, rng, small)
                    out[small, used[small]] = a >> HALF
                    used[small] += 1
                    low[small], rng[small] = a << HALF, r << HALF
        s.learn(m, x, f)
    lane = s.lane
    out[lane, used], out[lane, used + 1] = s.low >> HALF, s.low & WORD
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * n
    for at_lane, k in enumerate(order):
        words[k] = out[at_lane, : used[at_lane] + 2].copy()
    return words


def decode(words: list[np.ndarray], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block, from its words and its number of ids."""
    if not words:
        return []
    order = np.argsort([-k for k in lengths], kind="stable")
    size = np.array([lengths[k] for k in order])
    s = _Lanes(size)
    n, longest = len(words), int(size[0])
    read = np.zeros((n, max(len(w) for w in words) + 2), np.uint32)
    for lane, k in enumerate(order):
        read[lane, : len(words[k])] = words[k]
    code, used = (read[:, 0].astype(U) << HALF) | read[:, 1], np.full(n, 2, np.int64)
    ids = np.zeros((longest, n), np.int32)
    most = read.shape[1] - 1
    for t in range(longest):
        m = s.active(t)
        x = np.zeros(m, np.int64)
        f = _Foretold(s, m)
        low, rng, value = s.low[:m], s.range[:m], code[:m]
        for level in range(LEVELS):
            at = _Digit(s, level, s.node(m, level, x), f)
            rng >>= BTOTAL
            digit = at.find(np.minimum((value - low) // rng, U((1 << TOTAL) - 1)))
            begin, width = at.bounds(digit)
            low += rng * begin.view(U)
            rng *= width.view(U)
            at.learn(digit, f)
            x = (x << 4) | digit
            if level & 1:
                small = np.flatnonzero(rng < SMALL)
                if len(small):
                    a, r = _cut(low, rng, small)
                    value[small] = (value[small] << HALF) | read[small, np.minimum(used[small], most)]
                    used[small] += 1
                    low[small], rng[small] = a << HALF, r << HALF
        ids[t, :m] = x
        s.learn(m, x, f)
    out: list[np.ndarray] = [np.empty(0, np.int32)] * n
    for at_lane, k in enumerate(order):
        out[k] = ids[: size[at_lane], at_lane].copy()
    return out
