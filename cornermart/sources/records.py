"""Records of text files, cut where they end, by as many tasks as a file has ranges.

A range of a file can't tell by itself whether it begins within a quoted cell or string, or how deep.
But what it does to either state is a small table, and tables of neighbouring ranges can be put one
after the other. So files are read twice:

1. Each task gives the tables of its ranges, a few numbers each; the driver puts them together, file
   by file, and so knows the state in which every range begins.
2. Each task cuts its ranges at the ends of records. What comes before the first end and behind the
   last one is joined with the pieces of the neighbours; there are two such pieces to a range.

Spark's text source makes the ranges: it splits a file at any separator, and here that is a character
with which records end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import ship

State = tuple[int, int]  # whether within quotes, and the depth
Table = tuple[int, int, int, int]  # state behind a beginning outside of quotes, and within them


class Syntax(Protocol):
    """How records end. Texts come in pieces that end with the separator."""

    separator: str
    start: State

    def table(self, text: bytes) -> Table:
        """Where the text leads from either state of quotes and depth 0."""

    def ends(self, text: bytes, state: State) -> np.ndarray:
        """Places behind the records that end in the text."""


def follow(state: State, table: Table) -> State:
    quoted, depth = table[2:] if state[0] else table[:2]
    return quoted, state[1] + depth


def chained(first: Table, second: Table) -> Table:
    return (*follow(first[:2], second), *follow(first[2:], second))


class JsonArray:
    """Objects of one array, each ending with its brace at depth 1."""

    separator, start = "}", (0, 0)
    _escaped = re.compile(rb"\\.", re.DOTALL)  # an escape never ends with a brace
    _step = np.zeros(256, np.int8)
    _step[[ord("{"), ord("[")]] = 1
    _step[[ord("}"), ord("]")]] = -1
    _special = _step != 0
    _special[ord('"')] = True

    def _scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of quotes and brackets, their steps, and whether an odd number of quotes came before."""
        plain = self._escaped.sub(b"  ", text) if b"\\" in text else text
        symbols = np.frombuffer(plain, np.uint8)
        at = np.flatnonzero(self._special[symbols])
        symbols = symbols[at]
        return at, self._step[symbols].astype(np.int64), np.cumsum(symbols == ord('"')) & 1

    def table(self, text: bytes) -> Table:
        at, step, odd = self._scan(text)
        flips = int(odd[-1]) if len(at) else 0
        return flips, int(step[odd == 0].sum()), 1 - flips, int(step[odd == 1].sum())

    def ends(self, text: bytes, state: State) -> np.ndarray:
        at, step, odd = self._scan(text)
        outside = odd == state[0]
        at, step = at[outside], step[outside]
        return at[(step < 0) & (np.cumsum(step) + state[1] == 1)] + 1


class CsvLines:
    """Lines, but for breaks within quoted cells; a quote opens a cell only where the cell begins."""

    separator, start = "\n", (0, 0)

    @staticmethod
    def _quoted_behind(line: bytes, quoted: int) -> int:
        at = 0
        while True:
            if not quoted:
                if line[at : at + 1] != b'"':
                    at = line.find(b",", at) + 1
                    if not at:
                        return 0
                    continue
                quoted, at = 1, at + 1
            at = line.find(b'"', at) + 1
            if not at:
                return 1
            if line[at : at + 1] == b'"':
                at += 1
                continue
            quoted = 0
            at = line.find(b",", at) + 1
            if not at:
                return 0

    def _behind(self, lines: list[bytes], quoted: int) -> np.ndarray:
        out = np.full(len(lines), quoted, np.int8)
        for k, line in enumerate(lines):
            if quoted or b'"' in line:
                quoted = self._quoted_behind(line, quoted)
            out[k] = quoted
        return out

    def table(self, text: bytes) -> Table:
        lines = text.split(b"\n")[:-1]
        return int(self._behind(lines, 0)[-1]), 0, int(self._behind(lines, 1)[-1]), 0

    def ends(self, text: bytes, state: State) -> np.ndarray:
        lines = text.split(b"\n")[:-1]
        sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
        return np.cumsum(sizes)[self._behind(lines, state[0]) == 0]


Key = tuple[str, int]  # file, and where the range begins


def _pieces(batches: Iterator[pa.RecordBatch], separator: str) -> Iterator[tuple[Key, bytes]]:
    """Neighbouring rows of a range as one text, in order; several to a range."""
    mark = separator.encode()
    for batch in batches:
        files, blocks = batch["_file"].to_pylist(), batch["block"].to_numpy()
        values = batch["value"].cast(pa.binary()).to_pylist()
        cuts = [0, *(k for k in range(1, len(values)) if blocks[k] != blocks[k - 1] or files[k] != files[k - 1]), len(values)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield (files[a], int(blocks[a])), mark.join([*values[a:b], b""])


def _scan(spark: SparkSession, paths: list[str], syntax: Syntax) -> DataFrame:
    lines = spark.read.option("lineSep", syntax.separator).text(paths)
    return lines.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _states(lines: DataFrame, syntax: Syntax) -> tuple[dict[Key, State], dict[str, int]]:
    """The state at the beginning of each range, and where the last range of each file begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[Key, Table] = {}
        for key, text in _pieces(batches, syntax.separator):
            table = syntax.table(text)
            found[key] = chained(found[key], table) if key in found else table
        columns = [[f for f, _ in found], [b for _, b in found], [list(t) for t in found.values()]]
        types = (pa.string(), pa.int64(), pa.list_(pa.int64()))
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["_file", "block", "behind"])

    tables = lines.mapInArrow(run, "_file string, block bigint, behind array<bigint>").collect()
    states, last = {}, {}
    state = syntax.start
    for file, block, behind in sorted(map(tuple, tables)):
        if file not in last:
            state = syntax.start
        states[file, block], last[file] = state, block
        state = follow(state, tuple(behind))
    return states, last


CUT = "_file string, block bigint, part int, ends boolean, text string"
WHOLE, HEAD, TAIL = 0, 1, 2


def _cut(lines: DataFrame, syntax: Syntax, states: dict[Key, State], last: dict[str, int], whole: bool) -> DataFrame:
    """Either the records that lie wholly in a range, or the pieces at its two ends."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        columns = list(zip(*rows, strict=True)) or [()] * len(types)
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["_file", "block", "part", "ends", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, begun, held = None, syntax.start, False, []

        def rest() -> list[tuple]:
            """What is left of the range behind its last end; of a file's last range, even nothing."""
            text, final = b"".join(held).decode(), key and key[1] == last[key[0]]
            if final:
                text = text[:-1]  # nothing says that a file ends with a separator
            return [(*key, TAIL if begun else HEAD, False, text)] if (text or final) and not whole else []

        for now, text in _pieces(batches, syntax.separator):
            rows = []
            if now != key:
                rows += rest()
                key, state, begun, held = now, states[now], False, []
            ends = syntax.ends(text, state)
            state = follow(state, syntax.table(text))
            at = 0
            for end in ends.tolist():
                record = b"".join([*held, text[at:end]]) if held else text[at:end]
                if begun == whole:
                    rows.append((*key, WHOLE if begun else HEAD, True, record.decode()))
                held, at, begun = [], end, True
            if at < len(text):
                held.append(text[at:])
            yield batch_of(rows)
        yield batch_of(rest())

    return lines.mapInArrow(run, CUT)


def records(spark: SparkSession, paths: list[str], syntax: Syntax) -> DataFrame:
    """(_file, first, last, text): the records of each file, ``first`` and ``last`` of it or not.

    The text of a record is all of the file from the end of the one before to its own end. What
    comes behind the last end, and be it nothing, is last.
    """
    ship(spark)
    lines = _scan(spark, paths, syntax)
    states, last = _states(lines, syntax)
    no = F.lit(False)
    inner = _cut(lines, syntax, states, last, True).select("_file", no.alias("first"), no.alias("last"), "text")
    # two rows to a range, so the pieces of one file are few
    pieces = _cut(lines, syntax, states, last, False)
    order = Window.partitionBy("_file").orderBy("block", "part")
    place = F.coalesce(F.sum(F.col("ends").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = (
        pieces.withColumn("place", place)
        .groupBy("_file", "place")
        .agg(F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("parts"), F.bool_or("ends").alias("ended"))
        .select(
            "_file", (F.col("place") == 0).alias("first"), (~F.col("ended")).alias("last"), F.array_join(F.col("parts.text"), "").alias("text")
        )
    )
    return inner.unionByName(joined)
