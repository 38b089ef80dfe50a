"""Best-fit packing of tokenised documents into fixed-length sequences by exact-complement hashing.

Which documents share a sequence depends on lengths alone, and there are at most CAPACITY distinct
lengths. So Spark counts the pieces of each length, the driver plans over that small histogram
(sequences of equal make-up in one step), and Spark numbers the pieces of each length and looks
their places up in the plan. No group of pieces is ever gathered.

The plan takes the longest length left and fills the gap exactly with one, two or three lengths
whose sum is indexed under the availability counts; where no such sum exists, the longest length
that fits goes in and the rest of the gap is tried again.

Defined cases: null and empty texts are the end id alone; repeated rows are packed each by itself;
an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from .common import map_arrow
from .word_tokens import encoder, vocabulary_path

CAPACITY = 4096
END_ID = 1


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32; and part, rank (its number among
    the pieces of its length in that part). Must be written once before use: parts are tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, own_ids in zip(batch["doc_id"].to_pylist(), words.documents(batch["text"], END_ID), strict=True):
                ids = own_ids.astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes()), part, seen[len(own)]))
                    seen[len(own)] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], NAMES)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, SCHEMA)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"


@dataclass(frozen=True)
class Places:
    """Runs of ranks per length: ``each`` pieces of a run side by side in every sequence.

    Piece ``first + i`` of a run is in sequence ``sequence + i // each`` at
    ``offset + length * (i % each)``. Sorted by (length, first).
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.length.astype(np.float64)  # lengths select a block, ranks a run inside it
        low, high = np.searchsorted(key, length, "left"), np.searchsorted(key, length, "right")
        while (high - low > 1).any():  # all rows bisect at once
            middle = (low + high) // 2
            right = (high - low > 1) & (self.first[np.minimum(middle, len(key) - 1)] <= rank)
            low, high = np.where(right, middle, low), np.where(right | (high - low <= 1), high, middle)
        i = rank - self.first[low]
        return self.sequence[low] + i // self.each[low], self.offset[low] + length * (i % self.each[low])


class _Stock:
    """How many pieces of each length are left, and which sums of two lengths exist."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self._pairs: np.ndarray | None = None

    def pairs(self) -> np.ndarray:
        """Sums of two lengths; may hold some whose pieces have been used up since."""
        if self._pairs is None:
            lengths = sum(1 << int(k) for k in np.flatnonzero(self.left))
            sums = 0
            for k in np.flatnonzero(self.left):
                sums |= lengths << int(k)
            n = len(self.left)
            sums &= (1 << n) - 1
            raw = np.frombuffer(sums.to_bytes(n // 8 + 1, "little"), np.uint8)
            self._pairs, self._fresh = np.unpackbits(raw, bitorder="little")[:n].astype(bool), 0
        return self._pairs

    def enough(self, wanted: Counter) -> int:
        return min(int(self.left[k]) // n for k, n in wanted.items())

    def take(self, wanted: Counter, times: int) -> None:
        for k, n in wanted.items():
            self.left[k] -= n * times
            if not self.left[k] and self._pairs is not None:
                self._fresh += 1
                if self._fresh >= 64:  # the index shrinks; it is rebuilt now and then
                    self._pairs = None

    def pair(self, have: Counter, gap: int) -> Counter | None:
        """Two lengths that fill the gap, beside what the sequence has; the most unequal first."""
        half = gap // 2
        if gap < 2:
            return None
        small = np.arange(1, half + 1)
        for b in small[(self.left[small] > 0) & (self.left[gap - small] > 0)]:
            wanted = have + Counter([int(b), int(gap - b)])
            if self.enough(wanted):
                return wanted
        return None

    def exact(self, have: Counter, gap: int) -> Counter | None:
        """What the sequence has and one, two or three lengths that fill the gap."""
        if self.left[gap] and self.enough(one := have + Counter([gap])):
            return one
        pairs = self.pairs()
        if pairs[gap] and (two := self.pair(have, gap)):
            return two
        longest = np.arange(gap - 2, 0, -1)
        for a in longest[(self.left[longest] > 0) & pairs[gap - longest]]:
            if self.enough(have + Counter([int(a)])) and (three := self.pair(have + Counter([int(a)]), gap - int(a))):
                return three
        return None

    def best_fit(self, have: Counter, gap: int) -> int:
        """The longest length that still fits, 0 if none."""
        for k in np.flatnonzero(self.left[: gap + 1])[::-1]:
            if self.enough(have + Counter([int(k)])):
                return int(k)
        return 0


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Places:
    """Packs ``counts`` pieces of each length; every piece gets a place."""
    stock, rows, sequence = _Stock(counts, capacity), [], 0
    used = Counter()
    for length in range(capacity, 0, -1):
        while stock.left[length]:
            have, gap = Counter([length]), capacity - length
            while gap:
                if filled := stock.exact(have, gap):
                    have = filled
                    break
                fits = stock.best_fit(have, gap)
                if not fits:
                    break
                have, gap = have + Counter([fits]), gap - fits
            times, offset = stock.enough(have), 0
            stock.take(have, times)
            for k, each in sorted(have.items(), reverse=True):
                rows.append((k, used[k], sequence, each, offset))
                used[k] += each * times
                offset += k * each
            sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(len(rows), 5).T
    return Places(*columns, n_sequences=sequence)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = materialise(pieces(docs, vocabulary or vocabulary_path(), capacity), "pieces")
    sizes = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row per length: bounded
    places = plan({r["length"]: r["n"] for r in histogram}, capacity)
    numbered = cut.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = places.find(length, rank)
            own = [batch[n] for n in NAMES[:5]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset)], [*NAMES[:5], "sequence_id", "offset"])

    schema = SCHEMA.split(", part")[0] + ", sequence_id bigint, offset bigint"
    return map_arrow(numbered.select(*NAMES[:5], "rank"), run, schema)
