"""Quality classifier: a sparse rule ensemble compiled into one Spark column expression.

Boosted trees over text statistics propose rules (the conjunction on the way to each node), a lasso
logistic regression weighs them, and the rules with a weight become a sum of Spark conditions. The
statistics of a bounded sample of labelled documents are all that reaches the driver.

Defined cases: a null or empty text has statistics of zero and gets a score like any other;
repeated rows score alike; an empty table gives no rows; without labelled documents nothing is
learned and every score is 1; with one class only, the score is near that class's share. Columns
other than id and text are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from . import text_stats, trees
from .common import held_out, label_sample, let

FIT_ROWS = 8000  # labelled documents the ensemble is fitted on, at most
THRESHOLD = 0.7
ROUNDS, DEPTH = 24, 3
PENALTIES = (0.02, 0.008, 0.003, 0.001)

Path = tuple[tuple[int, bool, float], ...]


@dataclass(frozen=True)
class RuleEnsemble:
    """Log-odds = intercept + weights of the rules that hold."""

    intercept: float
    rules: tuple[tuple[float, Path], ...]
    names: tuple[str, ...] = text_stats.RATIOS

    def score(self, values: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for weight, path in self.rules:
            met = F.lit(True)
            for f, above, t in path:
                value = values[self.names[f]]
                met = met & ((value >= t) if above else (value < t))
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [
            f"{w:+.4f} if " + " and ".join(f"{self.names[f]} {'>=' if a else '<'} {t:.6g}" for f, a, t in path)
            for w, path in sorted(self.rules)
        ]


def simplified(path: Path) -> Path:
    """One bound per feature and side: the tightest on the path."""
    bounds: dict[tuple[int, bool], float] = {}
    for f, above, t in path:
        old = bounds.get((f, above))
        bounds[f, above] = t if old is None else max(old, t) if above else min(old, t)
    return tuple((f, above, t) for (f, above), t in sorted(bounds.items()))


def _matrix(x: np.ndarray, paths: list[Path]) -> np.ndarray:
    out = np.ones((len(x), len(paths)))
    for k, path in enumerate(paths):
        for f, above, t in path:
            out[:, k] *= (x[:, f] >= t) if above else (x[:, f] < t)
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient on the mean logistic loss; the intercept isn't penalised."""
    n, k = r.shape
    design = np.hstack([np.ones((n, 1)), r])
    vector = np.ones(k + 1)
    for _ in range(30):  # power iteration: curvature bound
        vector = design.T @ (design @ vector)
        vector /= np.linalg.norm(vector) or 1.0
    rate = 4.0 * n / max(np.linalg.norm(design @ vector) ** 2, 1e-9)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    beta = np.zeros(k + 1)
    beta[0] = np.log(mean / (1 - mean))
    ahead, momentum = beta, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30)))
        moved = ahead - rate * (design.T @ (p - y)) / n
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - rate * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, beta, momentum = moved + (momentum - 1) / following * (moved - beta), moved, following
    return float(beta[0]), beta[1:]


def learn(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """Rules from boosted trees, weights by lasso; the penalty that does best on a third kept back."""
    if not len(y):
        return RuleEnsemble(40.0, ())
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    _, grown = trees.boost(x, y, ROUNDS, DEPTH, least=2.0)
    paths = list(dict.fromkeys(simplified(p) for t in grown for p in t.paths()))
    r = _matrix(x, paths)
    _, first = np.unique(r, axis=1, return_index=True)  # rules that hold for the same rows
    keep = [k for k in sorted(first) if 0 < r[:, k].sum() < len(r)]
    paths, r = [paths[k] for k in keep], r[:, keep]
    back = np.arange(len(y)) % 3 == 2

    def loss(penalty: float) -> float:
        b, w = lasso_logistic(r[~back], y[~back], penalty)
        p = np.clip(1 / (1 + np.exp(-(b + r[back] @ w))), 1e-6, 1 - 1e-6)
        return -float(np.mean(y[back] * np.log(p) + (1 - y[back]) * np.log(1 - p)))

    penalty = min(PENALTIES, key=loss)
    b, w = lasso_logistic(r, y, penalty)
    return RuleEnsemble(b, tuple((float(v), p) for v, p in zip(w, paths, strict=True) if v))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> RuleEnsemble:
    """Fits the ensemble on at most ``rows`` labelled documents outside the held-out fold.

    A repeated id counts once, with the least statistics of its rows.
    """
    chosen = F.broadcast(label_sample(labels, "quality", rows))
    c = docs.select("doc_id", "text").join(chosen, "doc_id")
    c = c.select("doc_id", "label", text_stats.counts(F.col("text")).alias("c"))
    c = c.select("doc_id", "label", F.array(*text_stats.ratios(F.col("c")).values()).alias("x"))
    got = c.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")).collect()
    got.sort(key=lambda r: ((r.doc_id * 2654435761) & 0xFFFFFFFF, r.doc_id, r.x))
    return learn(
        np.array([r.x for r in got], float).reshape(len(got), len(text_stats.RATIOS)),
        np.array([r.label for r in got], float),
    )


def score_of(text: Column, model: RuleEnsemble) -> Column:
    return let(text_stats.counts(text), lambda c: model.score(text_stats.ratios(c)))


def assess(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    scored = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The documents predicted good, with all their columns."""
    return docs.filter(score_of(F.col("text"), model) >= THRESHOLD)
