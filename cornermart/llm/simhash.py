"""SimHash near-duplicates: 64-bit fingerprints, linked through BK-trees, joined into components.

1. A fingerprint per text, in one pass; then one row per distinct fingerprint, so that exact and
   very near copies, however many, never meet as pairs.
2. The bits are cut into RADIUS + 2 blocks. Two prints within RADIUS bits agree in two whole blocks
   at least, so each choice of two blocks shards the prints without losing a pair. A shard with more
   than SLICE prints is cut into slices, and each pair of slices is searched by itself.
3. A task grows one BK-tree per shard, searches it for the shard's own prints and reports, per
   print, one link to the smallest print it is connected to there: no pairs within a group.
4. The links are contracted by alternating large and small stars; each round is written to the
   shared checkpoint folder, so a lost executor costs one round at most.

Shard trees are built where the shard's rows are, since a tree of all prints has no size bound and
couldn't be broadcast.

Defined cases: null and empty texts have fingerprint zero and link like any other; repeated rows
each get a row; rows without id never name a component unless all of it lacks ids; an empty table
gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from ..session import materialise
from . import bktree
from .common import map_arrow, ship, unused

SHINGLE = 3
RADIUS = 3
SEED = 42
SLICE = 8192  # distinct prints of a shard that one tree holds, about
BATCH = 200_000  # prints a task handles at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is in over half of the hashes of the text's word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].astype(">u8")
        ones += np.unpackbits(some.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def prints_of(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The texts' fingerprints with their 64 bits as signed integers."""
    return np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print) with the 64 bits as a signed integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array(prints_of(batch["text"], shingle))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], prints], ["doc_id", "print"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, print bigint")


def block_masks(radius: int) -> list[int]:
    """For each choice of two of the radius + 2 blocks, the mask of their bits."""
    n = radius + 2
    cuts = [64 * k // n for k in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [blocks[i] | blocks[j] for i, j in combinations(range(n), 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, radius: int = RADIUS, slice_size: int = SLICE) -> DataFrame:
    """Links (a, b), b < a as unsigned, that connect all distinct prints within ``radius`` bits.

    At most one link per print, shard and slice: to the smallest print of its part there.
    """
    keys = F.array(*[F.col("print").bitwiseAND(F.lit(_signed(m))) for m in block_masks(radius)])
    sharded = prints.select("print", F.posexplode(keys).alias("choice", "key"))
    sharded = sharded.select("print", F.xxhash64("choice", "key").alias("shard"))
    crowds = sharded.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    n_slices = F.ceil(F.col("n") / slice_size).cast("int")
    mine = F.pmod(F.xxhash64("print"), n_slices).cast("int")
    placed = sharded.join(crowds, "shard").select("print", "shard", mine.alias("slice"), n_slices.alias("slices"))
    meetings = placed.select(
        "print", "shard", "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    )
    low, high = F.least("slice", "other"), F.greatest("slice", "other")
    group = F.xxhash64("shard", low, high)
    queries = (F.col("slice") == high).alias("asks")
    grows = (F.col("slice") == low).alias("grows")
    dealt = meetings.select(group.alias("group"), "print", grows, queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, BATCH):
            yield connect(table, radius)

    dealt = dealt.repartition("group").sortWithinPartitions("group")
    return map_arrow(dealt, run, "a bigint, b bigint")


def whole_groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Cuts a stream sorted by ``group`` into tables of at least ``least`` rows at group borders."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        group = table["group"].to_numpy()
        border = int(np.searchsorted(group, group[-1], "left"))
        if border:
            yield table.slice(0, border)
        rest = table.slice(border)
        held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield pa.Table.from_batches(held)


def connect(table: pa.Table, radius: int) -> pa.RecordBatch:
    """Links of one block of groups, from the parts that its near pairs form."""
    group = table["group"].to_numpy()
    prints = table["print"].to_numpy().view(np.uint64)
    order = np.lexsort((prints, group))  # so that the smallest place of a part is its smallest print
    group, prints = group[order], prints[order]
    grows, asks = table["grows"].to_numpy()[order], table["asks"].to_numpy()[order]
    tree, asking = np.flatnonzero(grows), np.flatnonzero(asks)
    label = np.arange(len(prints))
    if len(tree):
        forest = bktree.Forest(prints[tree], group[tree])
        for q, node in forest.near(prints[asking], group[asking], radius):
            label = bktree.joined(label, asking[q], tree[node])
    moved = np.flatnonzero(label != np.arange(len(label)))
    a, b = prints[moved].view(np.int64), prints[label[moved]].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def contract(edges: DataFrame) -> DataFrame:
    """Stars (a, b): b the smallest node of a's component; alternating large and small stars."""

    def closest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    def large(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = closest(both).withColumn("m", F.least("m", "a"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
        least = closest(down)
        moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    edges = materialise(edges.filter("a <> b").distinct(), "links")
    before = _checksum(edges)
    while before[0]:
        edges = materialise(small(large(edges)), "stars")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges


def parts(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, print, part, component_id) of every document; ``part`` is a print of its component."""
    printed = materialise(fingerprints(docs, shingle), "prints")
    distinct = materialise(printed.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    stars = contract(links(distinct.select("print"), radius))
    inner = stars.select(F.col("a").alias("print"), F.col("b").alias("part")).unionByName(
        stars.select(F.col("b").alias("print"), F.col("b").alias("part")).distinct()
    )
    parted = distinct.join(inner, "print", "left").withColumn("part", F.coalesce("part", "print"))
    named = parted.groupBy("part").agg(F.min("first").alias("component_id"))
    return printed.join(parted.select("print", "part").join(named, "part"), "print").select(
        "doc_id", "print", "part", "component_id"
    )


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, print, component_id) of every document."""
    return parts(docs, shingle, radius).select("doc_id", "print", "component_id")


def digest(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, distinct_ids: bool = True) -> DataFrame:
    """One document of every component, with all columns: the one whose id names it.

    Where that id is repeated or missing within the component, the first of its rows in order of
    text is kept. With ``distinct_ids`` an id that names several components is kept once, with the
    first text, and the others go; without, each component keeps its row.
    """
    found = materialise(parts(docs, shingle, radius), "components")
    names = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = found.filter("doc_id is not null").groupBy("doc_id").agg(F.bool_or(names).alias("names"), F.count("*").alias("n"))
    own, rows = unused(docs, "_kept"), unused(docs, "_rows")
    kept = materialise(kept.filter("names").select(F.col("doc_id").alias(own), F.col("n").alias(rows)), "kept")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    doc_id = F.col("doc_id").cast("bigint")
    match = doc_id == F.col(own)
    # merged at every size: the kept ids grow with the documents, so they are never broadcast
    once = docs.join(kept.filter(F.col(rows) == 1).hint("merge"), match, "left_semi").select(*columns)
    unsure = []  # rows whose id doesn't tell which of them is kept
    if not kept.filter(F.col(rows) > 1).isEmpty():
        unsure.append(docs.join(kept.filter(F.col(rows) > 1).hint("merge"), match, "left_semi"))
    if not found.filter("component_id is null").isEmpty():
        unsure.append(docs.filter(doc_id.isNull()))
    if not unsure:
        return once
    ship(docs.sparkSession)
    own_print = F.arrow_udf(lambda texts: pa.array(prints_of(texts, shingle)), LongType())
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = F.struct("text", *[F.col(f"`{c}`") for c in others], F.col("doc_id"))
    again = reduce(DataFrame.unionByName, unsure).select(
        doc_id.alias("_id"), own_print(F.col("text").cast("string")).alias("_print"), whole.alias("_row")
    )
    # combined before the shuffles: copies, however many, meet as one row per task
    again = again.groupBy("_id", "_print").agg(F.min("_row").alias("_row"))
    told = found.filter(names).select(F.col("doc_id").alias("_told"), F.col("print").alias("_of"), "part").distinct()
    first = again.join(told.hint("merge"), F.col("_id").eqNullSafe(F.col("_told")) & (F.col("_print") == F.col("_of")))
    first = first.groupBy("_id", "part").agg(F.min("_row").alias("_row"))
    if distinct_ids:
        first = first.groupBy("_id", F.when(F.col("_id").isNull(), F.col("part")).alias("part")).agg(F.min("_row").alias("_row"))
    return once.unionByName(first.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
