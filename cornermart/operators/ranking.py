"""Global NTILE without a one-task window, a join or a sort of all rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

FEW = 4000  # rows that the driver may sort


def tile_ends(n_rows: int, tiles: int) -> list[int]:
    """Last 1-based rank of each tile but the last; the first ``n_rows % tiles`` hold one row more."""
    small, larger = divmod(n_rows, tiles)
    return [k * small + min(k, larger) for k in range(1, tiles)]


def _constant(value, dtype: DataType) -> Column:
    """A literal of exactly this type; times as text, which no time zone moves."""
    return F.lit(value.isoformat(" ") if isinstance(value, datetime) else value).cast(dtype)


def _place(values: list[Column]) -> Column:
    """A row's place in the order: NULLs come last."""
    return F.struct(*[part for v in values for part in (v.isNull(), v)])


def _key(row: tuple) -> tuple:
    """Sorts rows on the driver as ``_place`` does in Spark: NaN above all numbers, NULL above it."""
    return tuple((v is None, v != v, 0 if v is None or v != v else v) for v in row)


class _Bracket:
    """Where the row with a given rank is: between two rows, behind ``before`` others."""

    def __init__(self, rank: int, n_rows: int):
        self.rank, self.before, self.inside = rank, 0, n_rows
        self.low: tuple | None = None
        self.high: tuple | None = None
        self.row: tuple | None = None  # once it is known

    def narrowed(self, sample: list[tuple]) -> tuple[tuple, tuple]:
        """Rows of the sorted sample that the wanted one is most likely between."""
        at = (self.rank - self.before) / self.inside * len(sample)
        spread = 2 * len(sample) ** 0.5  # four standard deviations, at most
        return sample[max(int(at - spread), 0)], sample[min(int(at + spread), len(sample) - 1)]

    def told(self, low: tuple, high: tuple, n: tuple[int, int, int, int]) -> None:
        """Takes in how many rows are below and not above either of two rows."""
        below_low, to_low, below_high, to_high = n
        end = self.before + self.inside
        if below_low < self.rank <= to_low:
            self.row = low
        elif below_high < self.rank <= to_high:
            self.row = high
        elif self.rank <= below_low:
            self.high, end = low, below_low
        elif self.rank > to_high:
            self.low, self.before = high, to_high
        else:
            self.low, self.high, self.before, end = low, high, to_low, below_high
        self.inside = end - self.before


def cuts(df: DataFrame, n_rows: int, tiles: int, order: list[str]) -> list[tuple]:
    """The last row of each tile but the last, as values of the ``order`` columns.

    The wanted ranks are bracketed by rows of a sample, exact counts tell whether the brackets hold
    them, and the rows of a bracket are sampled in turn until they are few enough to be sorted on the
    driver. Each round narrows a bracket about tenfold; it is two scans of the order columns without
    a shuffle, and the driver gets some thousand rows. A sample that misleads costs a round, no more.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    here = _place([F.col(c) for c in order])

    def row_place(row: tuple) -> Column:
        return _place([_constant(v, types[c]) for c, v in zip(order, row, strict=True)])

    brackets = [_Bracket(rank, n_rows) for rank in tile_ends(n_rows, tiles) if rank]
    drawn_before = 0
    while live := [b for b in brackets if b.row is None]:
        picks, chance = [], F.rand(drawn_before)  # by row, as rows may repeat; another seed each round
        drawn_before += 1
        for k, b in enumerate(live):
            share = 1.0 if b.inside <= FEW else FEW / 2 / b.inside
            chosen = chance < share
            if b.low is not None:
                chosen = chosen & (here > row_place(b.low))
            if b.high is not None:
                chosen = chosen & (here < row_place(b.high))
            picks.append(F.when(chosen, F.lit(k)))
        drawn = df.select(*order, F.array_compact(F.array(*picks)).alias("_of")).filter(F.size("_of") > 0).collect()
        tries = []
        for k, b in enumerate(live):
            rows = sorted((tuple(r[c] for c in order) for r in drawn if k in r["_of"]), key=_key)
            if b.inside <= FEW:
                b.row = rows[b.rank - b.before - 1]
            elif rows:
                tries.append((b, *b.narrowed(rows)))
        counts = [F.count_if(c).alias(f"c{i}_{j}") for i, (_, low, high) in enumerate(tries) for j, c in enumerate(
            (here < row_place(low), here <= row_place(low), here < row_place(high), here <= row_place(high))
        )]
        if counts:
            n = tuple(df.agg(*counts).first())
            for i, (b, low, high) in enumerate(tries):
                b.told(low, high, n[4 * i : 4 * i + 4])
    return [b.row for b in brackets]


def add_ntiles(df: DataFrame, tiles: int, orders: dict[str, list[str]]) -> DataFrame:
    """Add one tile column per entry of ``orders``, each ending in a unique set of columns.

    A row's tile is one more than the number of tile ends before it, so once the few cut rows are
    known the tiles are plain column expressions. ``df`` is scanned several times: give a stored table.
    """
    n_rows = df.count()
    types = {f.name: f.dataType for f in df.schema.fields}
    tiled = {}
    for name, order in orders.items():
        here = _place([F.col(c) for c in order])
        found = cuts(df, n_rows, tiles, order)
        ends = [_place([_constant(v, types[c]) for c, v in zip(order, cut, strict=True)]) for cut in found]
        tiled[name] = reduce(Column.__add__, [(here > end).cast("int") for end in ends], F.lit(1))
    return df.withColumns(tiled)
