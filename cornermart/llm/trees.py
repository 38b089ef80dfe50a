"""Small gradient-boosted trees in numpy, for fitting on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Tree:
    """Node arrays; a leaf has feature -1. Rows with value >= threshold go right."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int32)
        rows = np.arange(len(x))
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at]
            over = x[rows, np.maximum(f, 0)] >= self.threshold[at]
            at = np.where(inner, np.where(over, self.right[at], self.left[at]), at)

    def paths(self) -> list[tuple[tuple[int, bool, float], ...]]:
        """The conditions on the way to every node but the root: (feature, above, threshold)."""
        found, stack = [], [(0, ())]
        while stack:
            node, path = stack.pop()
            if path:
                found.append(path)
            if self.feature[node] >= 0:
                f, t = int(self.feature[node]), float(self.threshold[node])
                stack.append((int(self.left[node]), (*path, (f, False, t))))
                stack.append((int(self.right[node]), (*path, (f, True, t))))
        return found


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Per feature the thresholds to try: middles between neighbouring values or quantiles."""
    edges = []
    for column in x.T:
        v = np.unique(column)
        if len(v) > BINS:
            v = np.unique(np.quantile(column, np.linspace(0, 1, BINS)))
        edges.append((v[1:] + v[:-1]) / 2)
    return edges


def fit_tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least: float) -> Tree:
    """One regression tree on gradients and hessians, level by level over histograms."""
    feature, threshold, left, right, value = [], [], [], [], []

    def add(rows: np.ndarray, level: int) -> int:
        node = len(feature)
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        feature.append(-1), threshold.append(0.0), left.append(-1), right.append(-1)
        value.append(-sum_g / (sum_h + 1.0))
        if level == depth or sum_h < 2 * least:
            return node
        best = (1e-6, -1, -1)
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            b = binned[rows, f]
            lg = np.cumsum(np.bincount(b, g[rows], len(cuts) + 1))[:-1]
            lh = np.cumsum(np.bincount(b, h[rows], len(cuts) + 1))[:-1]
            gain = lg**2 / (lh + 1) + (sum_g - lg) ** 2 / (sum_h - lh + 1) - sum_g**2 / (sum_h + 1)
            gain[(lh < least) | (sum_h - lh < least)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] >= 0:
            _, f, k = best
            over = binned[rows, f] > k
            feature[node], threshold[node] = f, float(edges[f][k])
            left[node] = add(rows[~over], level + 1)
            right[node] = add(rows[over], level + 1)
        return node

    add(np.arange(len(binned)), 0)
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


def boost(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float = 0.3, weight: np.ndarray | None = None, least: float = 1.0) -> tuple[float, list[Tree]]:
    """Logistic boosting; returns the starting log-odds and trees whose values are scaled by ``rate``."""
    w = np.ones(len(y)) if weight is None else weight
    mean = np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)], axis=1)
    score, trees = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = fit_tree(binned, edges, w * (p - y), w * p * (1 - p), depth, least)
        tree = Tree(tree.feature, tree.threshold, tree.left, tree.right, tree.value * rate)
        trees.append(tree)
        score += tree.predict(x)
    return start, trees
