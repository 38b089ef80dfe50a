"""Context-mixing range coder for token ids, one step an id, many blocks in lock step.

An id has one distribution, the weighted sum of three predictions:

* order 2 and order 1: the id that last followed the two ids before, and the one before, in its block;
* order 0: how often each id occurs behind the ids of one class, in the whole segment. The classes, at
  most 16, put together ids with like successors. These counts are the segment's model and stored with it.

The weights are learnt online, per confidences of both foretold ids and whether they agree, by the share
each prediction had in the probability of the id that came.

A block is coded on its own: its foretold ids and weights start afresh, and all blocks given at once
advance one id per step, each as one lane of numpy arrays. The range coder keeps 64 bits and moves 32-bit
words; where the range gets too small it is cut at the word border, so no carry ever runs back.
"""

from __future__ import annotations

import zlib

import numpy as np

MAX_ID = 1 << 16
CLASSES = 16
SPREAD = 64  # groups of successors by which classes are found
ROUNDS = 4

U = np.uint64
ROW1, ROW2 = 1 << 10, 1 << 10  # places for order-1 and order-2 predictions of a lane
SURE = 7  # highest confidence of a prediction
SCALE = 16  # bits of a class's counts
BITS = 14  # bits of the weights
TOTAL = BITS + SCALE  # bits of the mixed distribution
PACE = 4  # weights move by a 16th
GAIN = 1008  # what a right prediction gains: weights stay below 16 * GAIN + 32, so that order 0 keeps 224 at least
CONTEXTS = 2 * (SURE + 1) ** 2  # two confidences, and whether both foretell the same id
UNIT = 1 << 17  # a confidence of 1 in the tables
#: By confidence and whether it was right, confidence * UNIT afterwards; 0 where the id gives way to the one that came.
AFTER = np.array([c * UNIT for k in range(SURE + 1) for c in (k >> 1, min(k + 1, SURE) if k else 0)], np.int32)
SMALL, WORD, HALF, BTOTAL = U(1 << 32), U(0xFFFFFFFF), U(32), U(TOTAL)


def _first_weights() -> np.ndarray:
    """Weights of order 2 (lower 16 bits) and order 1 before anything is learnt; one will do where both agree."""
    c2, c1, same = np.meshgrid(np.arange(SURE + 1), np.arange(SURE + 1), np.arange(2), indexing="ij")
    most = 16 * GAIN
    w2 = np.where(same == 1, most * (c1 + c2) // (c1 + c2 + 2), most * c2 // (c2 + 2))
    w1 = np.where(same == 1, 0, (most - w2) * c1 // (c1 + 3))
    return (w2 + (w1 << 16)).astype(np.int32).ravel()


WEIGHTS = _first_weights()


def numbers(alphabet: np.ndarray) -> np.ndarray:
    """The place of each id among those of the alphabet."""
    out = np.zeros(MAX_ID, np.uint16)
    out[alphabet] = np.arange(len(alphabet))
    return out


def _classes(before: np.ndarray, after: np.ndarray, n: int) -> np.ndarray:
    """A class for each of ``n`` symbols, by the symbols after it; the same for the same input."""
    at = before * SPREAD
    at += after & (SPREAD - 1)
    seen = np.bincount(at, minlength=n * SPREAD).reshape(n, SPREAD).astype(np.float32)
    total = seen.sum(1)
    like = np.log((seen.sum(0) + 1) / (total.sum() + SPREAD)).astype(np.float32)
    share = (seen + 4 * np.exp(like)) / (total[:, None] + 4)
    first = np.argsort(-total, kind="stable")[:CLASSES]
    of = np.zeros(n, np.int64)
    centre = share[first]
    for _ in range(ROUNDS):  # each symbol goes to the class under which its successors are likeliest
        of = (seen @ np.log(centre).T).argmax(1)
        member = np.zeros((len(first), n), np.float32)
        member[of, np.arange(n)] = 1
        sums = member @ seen
        centre = (sums + 4 * np.exp(like)) / (sums.sum(1, keepdims=True) + 4)
    return of


class Model:
    """Order 0 of one segment: its ids, the class of each, and where each begins among a class's counts."""

    def __init__(self, alphabet: np.ndarray, of: np.ndarray, counts: np.ndarray):
        self.alphabet, self.of = alphabet, of
        n = len(alphabet)
        if not n or (alphabet >= MAX_ID).any() or (np.diff(alphabet.astype(np.int64)) <= 0).any() or (of >= CLASSES).any():
            raise ValueError("a segment's model is damaged")
        if (counts.sum(1, dtype=np.int64) != 1 << SCALE).any():
            raise ValueError("a segment's model is damaged")
        self.start = np.zeros((CLASSES, n + 1), np.int32)
        np.cumsum(counts, axis=1, out=self.start[:, 1:])

    def slots(self) -> np.ndarray:
        """The id that has each of a class's counts, class by class."""
        n = len(self.alphabet)
        return np.repeat(np.tile(np.arange(n, dtype=np.uint16), CLASSES), np.diff(self.start, axis=1).ravel())

    @classmethod
    def of_blocks(cls, blocks: list[np.ndarray]) -> Model:
        ids = np.concatenate(blocks)
        alphabet = np.flatnonzero(np.bincount(ids, minlength=MAX_ID)).astype(np.uint16)
        n = len(alphabet)
        symbol = numbers(alphabet).take(ids).astype(np.int64)
        before = np.roll(symbol, 1)
        before[np.cumsum([0, *map(len, blocks)])[:-1]] = 0  # a block's first id comes behind the lowest id
        of = _classes(before, symbol, n)
        seen = np.bincount(of.take(before) * n + symbol, minlength=CLASSES * n).reshape(CLASSES, n)
        seen[seen.sum(1) == 0, 0] = 1
        there = seen > 0
        counts = there + seen * ((1 << SCALE) - there.sum(1))[:, None] // seen.sum(1)[:, None]
        counts[np.arange(CLASSES), seen.argmax(1)] += (1 << SCALE) - counts.sum(1)
        return cls(alphabet, of.astype(np.uint8), counts)

    def spans(self) -> np.ndarray:
        """Begin and count of each id in each class, two 32-bit numbers side by side in one of 64."""
        return np.stack((self.start[:, :-1], np.diff(self.start, axis=1)), axis=-1).view(np.int64).ravel()

    def packed(self) -> np.ndarray:
        """Begin, and above it count less 1, as 32-bit numbers; of use for ids that occur in the class."""
        return (self.start[:, :-1] + ((np.diff(self.start, axis=1) - 1) << 16)).view(np.uint32).ravel()

    def stored(self) -> bytes:
        """Number of ids, crc32 of the rest, gaps of the ids, classes, and counts of each class with those that aren't 0."""
        counts = np.diff(self.start, axis=1)
        there = counts > 0
        body = np.diff(self.alphabet, prepend=np.uint16(0)).astype("<u2").tobytes() + self.of.tobytes()
        body += np.packbits(there).tobytes() + (counts[there] - 1).astype("<u2").tobytes()
        return len(self.alphabet).to_bytes(4, "little") + zlib.crc32(body).to_bytes(4, "little") + zlib.compress(body, 1)

    @classmethod
    def restored(cls, raw: bytes) -> Model:
        n = int.from_bytes(raw[:4], "little")
        try:
            body = zlib.decompress(raw[8:])
        except zlib.error:
            body = b""
        if not body or zlib.crc32(body) != int.from_bytes(raw[4:8], "little"):
            raise ValueError("a segment's model is damaged")
        alphabet = np.cumsum(np.frombuffer(body, "<u2", n, 0), dtype=np.uint16)
        of = np.frombuffer(body, "u1", n, 2 * n)
        bits = -(-CLASSES * n // 8)
        there = np.unpackbits(np.frombuffer(body, "u1", bits, 3 * n), count=CLASSES * n).view(bool).reshape(CLASSES, n)
        counts = np.zeros((CLASSES, n), np.int64)
        counts[there] = np.frombuffer(body, "<u2", -1, 3 * n + bits).astype(np.int64) + 1
        return cls(alphabet, of, counts)


class _Order0:
    """The models of all lanes, end to end, and where each lane's begins."""

    def __init__(self, models: list[Model], of_lane: np.ndarray):
        sizes = np.array([len(m.alphabet) for m in models])
        self.span = np.concatenate([m.spans() for m in models])
        self.slot = np.concatenate([m.slots() for m in models])
        at = CLASSES * (np.cumsum(sizes) - sizes)
        of = [m.of.astype(np.int32) for m in models]
        row = np.concatenate([a + o * n for a, o, n in zip(at.tolist(), of, sizes.tolist(), strict=True)])
        cell = np.concatenate([(k * CLASSES + o) << SCALE for k, o in enumerate(of)])
        self.place = np.stack((row, cell), axis=-1).view(np.int64).ravel()  # gathered together
        self.symbols = (np.cumsum(sizes) - sizes)[of_lane]


class _Lanes:
    """Predictions, weights and coder state of all lanes; lanes are ordered by falling length."""

    def __init__(self, lengths: np.ndarray, order0: _Order0 | None):
        n = len(lengths)
        self.order0 = order0
        self.active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left").tolist()  # lanes at each step
        self.last = np.zeros(n * (ROW1 + ROW2), np.int32)  # symbol + UNIT * confidence, order 1 of all lanes, then order 2
        self.weight = np.tile(WEIGHTS, n)
        lane = np.arange(n, dtype=np.int32)
        self.begin, self.at_weight = np.stack((lane * ROW1, n * ROW1 + lane * ROW2)), lane.astype(np.int64) * CONTEXTS
        self.p1, self.p2 = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.low, self.range = np.zeros(n, U), np.full(n, ~U(0))


class _Step:
    """The mixed distribution of the next symbol in the first ``m`` lanes.

    Arrays of two rows hold what order 1 (first) and order 2 foretell; all numbers but the coder's have 32 bits.
    """

    def __init__(self, s: _Lanes, m: int):
        self.s, self.m = s, m
        p1 = s.p1[:m]
        at = np.empty((2, m), np.int32)
        np.bitwise_and(p1, ROW1 - 1, out=at[0])
        mixed = np.multiply(p1, 40503, out=at[1])  # may run over; the bits used are right
        mixed += s.p2[:m]
        mixed >>= 3
        mixed &= ROW2 - 1
        at += s.begin[:, :m]
        self.at = at.astype(np.int64)
        entry = s.last.take(self.at)
        self.known = entry & 0xFFFF
        entry >>= 16
        self.sure = entry  # twice the confidences
        self.same = self.known[0] == self.known[1]
        context = entry[1] << 3
        context += entry[0]
        context += self.same
        self.context = context + s.at_weight[:m]
        self.w = s.weight.take(self.context)
        self.big = np.empty((2, m), np.int32)
        np.bitwise_and(self.w, -1 << SCALE, out=self.big[0])
        np.left_shift(self.w, SCALE, out=self.big[1])  # the other weight is shifted out
        self.w0 = (1 << TOTAL) - self.big[0]
        self.w0 -= self.big[1]
        self.w0 >>= SCALE
        if s.order0 is not None:
            place = s.order0.place.take(p1 + s.order0.symbols[:m])
            self.row, self.cell = place & 0xFFFFFFFF, place >> 32

    @property
    def x1(self) -> np.ndarray:
        return self.known[0]

    @x1.setter
    def x1(self, x: np.ndarray) -> None:
        self.known[0] = x

    @property
    def x2(self) -> np.ndarray:
        return self.known[1]

    @x2.setter
    def x2(self, x: np.ndarray) -> None:
        self.known[1] = x

    def bounds(self, x: np.ndarray, span: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of the symbol's interval, of 2 ** TOTAL; ``span`` has those in order 0, if known."""
        if span is None:
            parts = self.s.order0.span.take(self.row + x).view(np.int32)
            span = parts[::2], parts[1::2]
        begin, size = span[0] * self.w0, span[1] * self.w0
        self.hit = (x == self.known).astype(np.int32)
        share = self.big * self.hit
        size += share[0]
        size += share[1]
        np.multiply(self.big, x > self.known, out=share)
        begin += share[0]
        begin += share[1]
        return begin, size

    def find(self, value: np.ndarray) -> np.ndarray:
        """The symbol in whose interval ``value`` is."""
        order0, known, big = self.s.order0, self.known, self.big
        parts = order0.span.take(known + self.row).view(np.int32)
        begin, end = parts[:, ::2] * self.w0, parts[:, 1::2] * self.w0
        begin += big[::-1] * (known > known[::-1])
        end += begin
        end += big
        end += big[::-1] * self.same
        above = value >= end
        taken = big * above
        left = value - taken[0]
        left -= taken[1]
        left = (left / self.w0).astype(np.int64)  # exact: the numbers are far below 2 ** 53
        np.minimum(left, (1 << SCALE) - 1, out=left)
        left += self.cell
        x = order0.slot.take(left).astype(np.int32)
        found = (value >= begin) > above
        np.copyto(x, known[1], where=found[1])
        np.copyto(x, known[0], where=found[0])
        return x

    def learn(self, x: np.ndarray) -> None:
        """Weights move towards the prediction that was right, order 2 before order 1; confidence grows, or is halved."""
        s, m, hit = self.s, self.m, self.hit
        fade = self.w >> PACE
        fade &= 0x0FFF0FFF  # of both weights at once
        w = self.w
        w -= fade
        w += hit[1] * GAIN
        w += (hit[0] > hit[1]) * np.int32(GAIN << 16)
        s.weight[self.context] = w
        self.sure += hit
        after = AFTER.take(self.sure.astype(np.int64))
        change = x - self.known  # where the id gives way
        change += UNIT
        change *= after == 0
        after += self.known
        after += change
        s.last[self.at] = after
        s.p2[:m] = s.p1[:m]
        s.p1[:m] = x


def _cut(low: np.ndarray, rng: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and range of lanes whose range is small, the range ending at the word border at most."""
    a, r = low.take(small), rng.take(small)
    crosses = (a ^ (a + r)) > WORD
    return a, np.where(crosses, (~a + U(1)) & WORD, r)


def _in_steps(rows: np.ndarray) -> np.ndarray:
    """One row per step instead of one per lane, copied in squares that stay in the cache."""
    n, longest = rows.shape
    out = np.empty((longest, n), rows.dtype)
    for k in range(0, n, 64):
        for t in range(0, longest, 64):
            out[t : t + 64, k : k + 64] = rows[k : k + 64, t : t + 64].T
    return out


def encode(blocks: list[np.ndarray], models: list[Model], model_of: list[int]) -> list[np.ndarray]:
    """The 32-bit words of each block, by the model that its number in ``model_of`` names."""
    if not blocks:
        return []
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    lengths = np.array([len(blocks[k]) for k in order])
    s = _Lanes(lengths, None)
    n, longest = len(blocks), int(lengths[0])
    number, span = [numbers(m.alphabet) for m in models], [m.packed() for m in models]
    row = [m.of.astype(np.int64) * len(m.alphabet) for m in models]
    rows, spans = np.zeros((n, longest), np.uint16), np.zeros((n, longest), np.uint32)
    for lane, k in enumerate(order):  # order 0 needs no other lane and no earlier step
        size, j = lengths[lane], model_of[k]
        x = rows[lane, :size] = number[j].take(blocks[k])
        before = np.zeros(size, np.int64)
        before[1:] = x[:-1]
        spans[lane, :size] = span[j].take(row[j].take(before) + x)
    symbols, spans = _in_steps(rows), _in_steps(spans)
    out, lanes = [], []
    for t, m in enumerate(s.active):
        x = symbols[t, :m].astype(np.int32)
        step = _Step(s, m)
        low, rng = s.low[:m], s.range[:m]
        span = spans[t, :m]
        begin, size = step.bounds(x, ((span & 0xFFFF).view(np.int32), ((span >> 16) + np.uint32(1)).view(np.int32)))
        rng >>= BTOTAL
        low += rng * begin.view(np.uint32)
        rng *= size.view(np.uint32)
        step.learn(x)
        small = np.flatnonzero(rng < SMALL)
        if len(small):
            a, r = _cut(low, rng, small)
            out.append((a >> HALF).astype(np.uint32)), lanes.append(small)
            low[small], rng[small] = a << HALF, r << HALF
    for last in (s.low >> HALF, s.low & WORD):
        out.append(last.astype(np.uint32)), lanes.append(np.arange(n))
    lane = np.concatenate(lanes).astype(np.uint16 if n <= 1 << 16 else np.uint32)
    coded = np.concatenate(out).take(np.argsort(lane, kind="stable"))
    ends = np.cumsum(np.bincount(lane, minlength=n))
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * n
    for own, k in zip(np.split(coded, ends[:-1]), order, strict=True):
        words[k] = own
    return words


def decode(words: list[np.ndarray], lengths: list[int], models: list[Model], model_of: list[int]) -> list[np.ndarray]:
    """The ids of each block, from its words, its number of ids and its model."""
    if not words:
        return []
    order = np.argsort([-k for k in lengths], kind="stable")
    size = np.array([lengths[k] for k in order])
    s = _Lanes(size, _Order0(models, np.array(model_of)[order]))
    n, longest = len(words), int(size[0])
    read = np.concatenate([words[k] for k in order])
    ends = np.cumsum([len(words[k]) for k in order])
    used = ends - [len(words[k]) for k in order]
    code = (read.take(used).astype(U) << HALF) | read.take(used + 1, mode="clip")
    used += 2
    symbols = np.zeros((longest, n), np.uint16)
    for t, m in enumerate(s.active):
        step = _Step(s, m)
        low, rng, value = s.low[:m], s.range[:m], code[:m]
        rng >>= BTOTAL
        x = step.find(np.minimum((value - low) // rng, U((1 << TOTAL) - 1)).astype(np.int32))
        begin, width = step.bounds(x)
        low += rng * begin.view(np.uint32)
        rng *= width.view(np.uint32)
        step.learn(x)
        small = np.flatnonzero(rng < SMALL)
        if len(small):
            a, r = _cut(low, rng, small)
            at = used.take(small)
            value[small] = (value.take(small) << HALF) | read.take(at, mode="clip")  # a damaged block may read on
            at += 1
            used[small] = at
            low[small], rng[small] = a << HALF, r << HALF
        symbols[t, :m] = x
    out: list[np.ndarray] = [np.empty(0, np.int32)] * n
    for row, k in zip(_in_steps(symbols), order, strict=True):
        out[k] = models[model_of[k]].alphabet.take(row[: lengths[k]]).astype(np.int32)
    return out
