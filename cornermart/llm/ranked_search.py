"""Ranked lexical search: the best documents of each item by weighted term frequencies, exactly.

1. Documents are read once: each becomes the terms it shares with the items, with their frequencies,
   and its number of terms. Document frequencies and lengths are sums over all of them.
2. A task searches its documents, some thousands at a time, with two trees: one over the items, one
   over the documents. A node holds, for each term, the greatest weight below it, so the product of
   an item node and a document node is at least any score between them. Pairs are refined from the
   roots down; where the bound is below the weakest k-th score of the node's items, all pairs below
   are left out. What remains is scored leaf by leaf, the highest bounds first.
3. The best k of each task are merged by item, in two steps.

Nothing depends on which pairs are left out but the time. Items are collected in blocks of bounded
text; documents and what they share with the items stay in Spark.

Defined cases: an item or document without term has no score; every row of the items is an item, also
with a repeated id or none, and every row of the documents ranks for itself; equal scores are ranked
by document id, missing ids last; an empty table gives no rows; texts of any length are read whole;
columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from .common import map_arrow

TOP = 20
BLOCK_CHARS = 4_000_000  # characters of items searched for together, about
LEAF = 32  # documents in a leaf
FANOUT = 8  # children of a node
HELD_DOCS = 4096  # documents in a tree
CELLS = 4_000_000  # cells of a tree's leaves: fewer documents where items have many terms
SALTS = 64

#: Bytes outside terms become spaces, A-Z become a-z (fixed values of the term class).
_TERM_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


@dataclass
class Items:
    """The items of a block: per term how often each holds it."""

    ids: list[int | None]
    term: dict[bytes, int]
    counts: list[dict[int, int]]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        term: dict[bytes, int] = {}
        counts = [dict(Counter(term.setdefault(t, len(term)) for t in terms_of((text or "").encode()))) for _, text in rows]
        return cls([item_id for item_id, _ in rows], term, counts)

    def weighted(self, weight: np.ndarray) -> np.ndarray:
        """A row per item: weight of each of its terms, repeats included."""
        out = np.zeros((len(self.ids), len(weight)))
        for k, count in enumerate(self.counts):
            places = list(count)
            out[k, places] = np.array(list(count.values())) * weight[places]
        return out


def _alike(rows: np.ndarray) -> np.ndarray:
    """An order in which rows with the same heaviest columns are neighbours."""
    if rows.shape[1] < 2:
        return np.arange(len(rows))
    heaviest = np.argpartition(-rows, 1, axis=1)[:, :2]
    swap = rows[np.arange(len(rows)), heaviest[:, 0]] < rows[np.arange(len(rows)), heaviest[:, 1]]
    heaviest[swap] = heaviest[swap][:, ::-1]
    return np.lexsort((heaviest[:, 1], heaviest[:, 0]))


def _levels(leaves: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of the nodes, level by level, from the roots to the given leaves.

    Node k of a level has the nodes FANOUT * k and on of the next one below it.
    """
    levels = [leaves]
    while len(levels[0]) > FANOUT:
        below = levels[0]
        levels.insert(0, np.maximum.reduceat(below, np.arange(0, len(below), FANOUT), axis=0))
    return levels


def _weakest(values: np.ndarray, levels: int) -> list[np.ndarray]:
    """Minima of the leaves' values for the nodes of each level."""
    out = [values]
    for _ in range(levels - 1):
        out.insert(0, np.minimum.reduceat(out[0], np.arange(0, len(out[0]), FANOUT)))
    return out


def _children(nodes: np.ndarray, partner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each node's children, below ``n``, with the node's partner."""
    below = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    other = np.repeat(partner, FANOUT)
    return below[below < n], other[below < n]


class Search:
    """The best documents of each item among those seen so far."""

    def __init__(self, weighted: np.ndarray, k: int):
        self.order = _alike(weighted)
        self.items = weighted[self.order]
        self.levels = _levels(self.items)
        n = len(weighted)
        self.k = k
        self.score = np.zeros((n, k))
        self.missing, self.doc = np.ones((n, k), bool), np.zeros((n, k), np.int64)
        self.scored = 0  # documents scored, summed over items

    def weakest(self) -> np.ndarray:
        """What a document must reach to count for each item: one at least."""
        return np.maximum(self.score[:, -1], 1)

    def _pairs(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, leaf, bound) of the pairs that may hold a document that counts."""
        least = _weakest(self.weakest(), len(self.levels))
        i = d = 0
        a, b = (x.ravel() for x in np.meshgrid(np.arange(len(self.levels[0])), np.arange(len(docs[0])), indexing="ij"))
        while True:
            own, place = np.unique(a, return_inverse=True)
            other, at = np.unique(b, return_inverse=True)
            bound = (self.levels[i][own] @ docs[d][other].T)[place, at]  # whole numbers below 2**53: exact
            open_ = bound >= least[i][a]
            a, b, bound = a[open_], b[open_], bound[open_]
            deeper_item, deeper_doc = i + 1 < len(self.levels), d + 1 < len(docs)
            if not len(a) or not (deeper_item or deeper_doc):
                return a, b, bound
            if deeper_item:
                i += 1
                a, b = _children(a, b, len(self.levels[i]))
            if deeper_doc:
                d += 1
                b, a = _children(b, a, len(docs[d]))

    def add(self, ids: np.ndarray, missing: np.ndarray, row: np.ndarray, term: np.ndarray, part: np.ndarray) -> None:
        """Looks at documents with ids, given the cells (document, term, frequency part) they have."""
        n, width = len(ids), self.items.shape[1]
        if not len(row):
            return
        first = np.flatnonzero(np.diff(row, prepend=-1))
        heaviest = np.zeros(n, np.int64)  # documents with the same heaviest term become neighbours
        by_part = np.lexsort((part * self.items.max(0)[term], row))
        heaviest[row[first]] = 1 + term[by_part[np.append(first[1:], len(row)) - 1]]
        order = np.argsort(heaviest, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        ids, missing, row = ids[order], missing[order], place[row]
        leaves = np.zeros((-(-n // LEAF), width))
        np.maximum.at(leaves, (row // LEAF, term), part)
        item, leaf, bound = self._pairs(_levels(leaves))
        cells = np.argsort(row // LEAF, kind="stable")
        cut = np.searchsorted((row // LEAF)[cells], np.arange(len(leaves) + 1))
        best = np.zeros(len(leaves))
        np.maximum.at(best, leaf, bound)
        pairs = np.argsort(leaf, kind="stable")
        pair_cut = np.searchsorted(leaf[pairs], np.arange(len(leaves) + 1))
        for k in np.argsort(-best, kind="stable").tolist():
            some = pairs[pair_cut[k] : pair_cut[k + 1]]
            asked = item[some][bound[some] >= self.weakest()[item[some]]]
            if len(asked):
                own = cells[cut[k] : cut[k + 1]]
                self._score(asked, row[own] - k * LEAF, term[own], part[own], ids[k * LEAF :][:LEAF], missing[k * LEAF :][:LEAF])

    def _score(self, asked: np.ndarray, row: np.ndarray, term: np.ndarray, part: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        columns, at = np.unique(term, return_inverse=True)
        docs = np.zeros((len(ids), len(columns)))
        docs[row, at] = part
        scores = self.items[np.ix_(asked, columns)] @ docs.T
        self.scored += scores.size
        better = (scores >= self.weakest()[asked][:, None]).any(1)
        asked, scores = asked[better], scores[better]
        if not len(asked):
            return
        score = np.hstack([self.score[asked], scores])
        doc = np.hstack([self.doc[asked], np.broadcast_to(ids, scores.shape)])
        none = np.hstack([self.missing[asked], np.broadcast_to(missing, scores.shape)])
        best = np.lexsort((doc, none, -score), axis=-1)[:, : self.k]
        take = lambda a: np.take_along_axis(a, best, 1)
        self.score[asked], self.doc[asked], self.missing[asked] = take(score), take(doc), take(none)

    def found(self) -> Iterator[tuple[int, int | None, int]]:
        """(item, document id, score) of all that count."""
        for k, j in zip(*np.nonzero(self.score > 0), strict=True):
            yield int(self.order[k]), None if self.missing[k, j] else int(self.doc[k, j]), int(self.score[k, j])


def shared_terms(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n_terms, terms, counts) of every document: what it shares with the items."""
    number = docs.sparkSession.sparkContext.broadcast(items.term)  # of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value.get
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch["text"]:
                words = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                found = Counter(map(known, words))
                found.pop(None, None)
                sizes.append(len(words)), terms.append(list(found)), counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n_terms", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, n_terms bigint, terms array<int>, counts array<bigint>")


def _best_of_tasks(vectors: DataFrame, items: Items, weight: np.ndarray, n_docs: int, all_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best ``k`` of each task."""
    held = vectors.sparkSession.sparkContext.broadcast((items, weight))
    size = max(LEAF, min(HELD_DOCS, CELLS // max(len(weight), 1) * LEAF))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, weights = held.value
        search = Search(some.weighted(weights), k)
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                batch = whole.slice(start, size)
                terms, counts = batch["terms"], batch["counts"]
                row = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy())
                tf = counts.flatten().to_numpy()
                m = 75 + 25 * batch["n_terms"].to_numpy() * n_docs // all_terms
                part = 1_000_000_000 * tf // (1000 * tf + 12 * m[row])
                ids = batch["doc_id"]
                search.add(
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), row, terms.flatten().to_numpy(), part.astype(float)
                )
        found = list(zip(*search.found(), strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[0], pa.int32()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int64())], ["item", "doc_id", "score"]
        )

    matching = vectors.filter(F.size("terms") > 0)
    return map_arrow(matching, run, "item int, doc_id bigint, score bigint")


def _block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    vectors = materialise(shared_terms(docs, items), "shared-terms")
    n_docs, all_terms = vectors.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    weight = np.zeros(len(items.term))
    for r in held:
        weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
    best = _best_of_tasks(vectors, items, weight, n_docs, all_terms or 1, k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = best.withColumn("salt", F.spark_partition_id() % SALTS)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    schema = "item int, item_id bigint"
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), schema)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item with a score above 0."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    out = []
    for b in range(blocks):
        own = rows.filter(block == b).collect() if blocks > 1 else rows.collect()
        out.append(_block(docs, Items.of(sorted(((r.item_id, r.text) for r in own), key=str)), k))
    return reduce(DataFrame.unionByName, out)
