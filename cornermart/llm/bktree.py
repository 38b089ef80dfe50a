"""BK-trees over 64-bit fingerprints, grown and searched level by level in numpy.

A node's children are keyed by their integer Hamming distance to it. A search within radius r that
stands at distance d from a node follows only the edges keyed d - r to d + r (triangle inequality).
Many trees, one per shard, form a forest, so that small shards cost no Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FRONTIER = 2_000_000  # (query, node) pairs held at once


class Forest:
    """One tree per distinct value of ``shard``; node k holds ``prints[k]``."""

    def __init__(self, prints: np.ndarray, shard: np.ndarray):
        order = np.argsort(shard, kind="stable")
        self.prints, self.order = prints[order], order
        self.shards, first = np.unique(shard[order], return_index=True)
        n = len(prints)
        self.roots = first.astype(np.int64)
        parent, key = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        place = np.full(n, -1, np.int64)  # where a print that isn't placed yet stands
        place[:] = np.repeat(self.roots, np.diff(np.append(first, n)))
        waiting = np.setdiff1d(np.arange(n), self.roots, assume_unique=True)
        while len(waiting):
            distance = np.bitwise_count(self.prints[waiting] ^ self.prints[place[waiting]]).astype(np.int64)
            edge = place[waiting] * 65 + distance
            _, settled, group = np.unique(edge, return_index=True, return_inverse=True)
            child = waiting[settled]  # the first to come to an edge becomes its node
            parent[child], key[child] = place[child], distance[settled]
            place[waiting] = child[group]
            rest = np.ones(len(waiting), bool)
            rest[settled] = False
            waiting = waiting[rest]
        inner = np.flatnonzero(parent >= 0)
        edge = parent[inner] * 65 + key[inner]
        by_edge = np.argsort(edge, kind="stable")
        self.edges, self.children = edge[by_edge], inner[by_edge]

    def near(self, prints: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, place of a print given to the forest) within ``radius``, in blocks."""
        at = np.searchsorted(self.shards, shard)
        known = at < len(self.shards)
        known[known] = self.shards[at[known]] == shard[known]
        query = np.flatnonzero(known)
        stack = [(query, self.roots[at[query]])]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                middle = len(q) // 2
                stack += [(q[:middle], node[:middle]), (q[middle:], node[middle:])]
                continue
            distance = np.bitwise_count(prints[q] ^ self.prints[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield q[hit], self.order[node[hit]]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), "right")
            width = high - low
            if width.any():
                q = np.repeat(q, width)
                step = np.arange(len(q)) - np.repeat(np.cumsum(width) - width, width)
                stack.append((q, self.children[np.repeat(low, width) + step]))


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (a forest of places, each pointing to one not larger) after linking a to b."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
