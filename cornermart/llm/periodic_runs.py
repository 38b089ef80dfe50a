"""Periodic runs of words: a sparse dynamic program over diagonals, one word after the other.

A run is a stretch of words with smallest period q, at least max(12, 2 q) long, that can't be made
longer. On the diagonal of lag q, where a word equals the one q places before, it shows as
consecutive matches, at least max(12 - q, q) and so never fewer than six. That makes the program
sparse: only where the next six words stood before in the text can a diagonal begin.

At each such place its earlier occurrences open a diagonal, if their left neighbour is another word
(otherwise theirs is open already); each open diagonal matches one word more or ends, and those that
end with enough matches give a run at once. Not opened are diagonals whose matches end too early for
their lag, told by comparing named windows of 6, 12, 24, ... words, and those of a multiple of a lag
that is open over the whole stretch: they end together with it and have its smaller period.

Defined cases: a null text has no words; an empty table gives no rows; repeated rows and ids get a row
each; runs are in order of start, then period, so ties don't arise; a text of any length is read
whole, its memory is linear in its words; columns other than id and text are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_arrow

SHORTEST = 12  # words in a run, at least
WINDOW = SHORTEST // 2  # matches that every run has on its diagonal
LONG_LIST = 64  # earlier places compared all at once

Run = tuple[int, int, int]  # start, length, period


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers that are equal where the pairs are; below the number of pairs."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)


def window_names(ids: np.ndarray) -> np.ndarray:
    """Row k: a number for each window of 6 * 2**k words, by content; -1 for windows that occur once.

    Rows end with the size at which no window occurs twice, or two don't fit beside each other.
    """
    names = _named(ids[:-1], ids[1:])
    names = _named(_named(names[:-2], names[2:])[:-2], names[4:])
    rows, size = [], WINDOW
    while True:
        again = np.bincount(names)[names] > 1
        if not again.any():
            break
        rows.append(np.full(len(ids) - WINDOW + 1, -1, np.int32))
        rows[-1][: len(names)][again] = names[again]
        if 4 * size > len(ids):
            break
        names = _named(names[:-size], names[size:])
        size *= 2
    return np.array(rows, np.int32).reshape(len(rows), len(ids) - WINDOW + 1)


def _prime_factors(q: int) -> list[int]:
    found, f = [], 2
    while f * f <= q:
        if q % f == 0:
            found.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return found + [q] * (q > 1)


def _least_period(ids: np.ndarray, start: int, length: int, q: int) -> bool:
    """Whether no smaller period than ``q`` holds; one that does divides q, as two q words fit."""
    part = ids[start : start + length]
    return not any((part[q // f :] == part[: length - q // f]).all() for f in _prime_factors(q))


class Diagonals:
    """The open diagonals of one text, and the runs of those that ended."""

    def __init__(self, ids: np.ndarray, names: np.ndarray):
        self.ids, self.names = ids, names
        self.name_list, self.word_list = names[0].tolist(), ids.tolist()
        self.rows = [memoryview(row) for row in names]
        self.sizes = WINDOW << np.arange(len(names))
        self.since: dict[int, int] = {}  # lag -> place of its first match
        self.seen: dict[int, dict[int, array]] = {}  # window -> left neighbour -> places
        self.runs: list[Run] = []

    def _end(self, lag: int, at: int) -> None:
        """The diagonal's last six matching words began at ``at``."""
        first = self.since.pop(lag)
        length = at + WINDOW - first + lag
        if length >= max(SHORTEST, 2 * lag) and _least_period(self.ids, first - lag, length, lag):
            self.runs.append((first - lag, length, lag))

    def _matches(self, i: int, lag: int) -> bool:
        need = max(SHORTEST - lag, lag)
        k = (need // WINDOW).bit_length() - 1
        if k >= len(self.rows) or i + need > len(self.ids):
            return False
        row, last = self.rows[k], i + need - (WINDOW << k)
        return 0 <= row[i] == row[i - lag] and 0 <= row[last] == row[last - lag]

    def _long_enough(self, i: int, places: array) -> list[int]:
        """Lags to those earlier places from which as many words match as a run needs.

        The matches needed are covered by a named window at either end of them.
        """
        if len(places) < LONG_LIST:
            return [i - j for j in places if self._matches(i, i - j)]
        lags = i - np.frombuffer(places, np.int64)
        need = np.maximum(SHORTEST - lags, lags)
        inside = i + need <= len(self.ids)
        lags, need = lags[inside], need[inside]
        row = np.searchsorted(self.sizes, need, "right") - 1
        inside = need < 2 * self.sizes[row]
        lags, need, row = lags[inside], need[inside], row[inside]
        last = i + need - self.sizes[row]
        first = self.names[row, i] == self.names[row, i - lags]
        second = self.names[row, last] == self.names[row, last - lags]
        return lags[first & second & (self.names[row, i] >= 0) & (self.names[row, last] >= 0)].tolist()

    def step(self, i: int) -> None:
        name, names = self.name_list[i], self.name_list
        if self.since:
            for lag in [q for q in self.since if names[i - q] != name or name < 0]:
                self._end(lag, i - 1)
        if name < 0:
            return
        left = self.word_list[i - 1] if i else -1
        before = self.seen.setdefault(name, {})
        for other, places in before.items():
            if other != left:
                for lag in reversed(self._long_enough(i, places)):
                    if not any(lag % p == 0 and first - p <= i - lag for p, first in self.since.items()):
                        self.since[lag] = i
        before.setdefault(left, array("q")).append(i)

    def finish(self) -> list[Run]:
        for lag in list(self.since):
            self._end(lag, len(self.name_list) - 1)
        return sorted(self.runs, key=lambda r: (r[0], r[2]))


def runs_of(words: list) -> list[Run]:
    """All runs of a sequence of words, by start, then period."""
    if len(words) < SHORTEST:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return []
    names = window_names(ids)
    if not len(names):
        return []
    open_ = Diagonals(ids, names)
    past = -1
    for i in np.flatnonzero(names[0] >= 0).tolist():
        if i > past + 1 and open_.since:
            open_.step(past + 1)  # a window that occurs once ends all diagonals
        open_.step(i)
        past = i
    if past + 1 < len(open_.name_list) and open_.since:
        open_.step(past + 1)
    return open_.finish()


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that repeat a run's first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [words[k] for k in np.flatnonzero(~drop).tolist()]


SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
HELD_BYTES = 32 << 20  # collapsed text handed on at once


def detect(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs and the collapsed text of every document.

    ``change`` may replace a document's words, given with its id, before they are looked at.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        types = (pa.int64(), pa.int64(), RUN_TYPE, pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n_words", "runs", "collapsed"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                # bytes are split at U+0020 and U+0009 to U+000D, and nowhere else
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                if change:
                    words = change(doc_id, words)
                runs = runs_of(words)
                kept = b" ".join(collapsed(words, runs))
                found = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                rows.append((doc_id, len(words), found, kept.decode()))
                size += len(kept)
                if size > HELD_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, SCHEMA)


def report(found: DataFrame) -> DataFrame:
    """The greatest run of every document and digests of its runs and its collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    length, period = -F.col("best.col1"), F.col("best.period")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(best.col1 * -1000) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
