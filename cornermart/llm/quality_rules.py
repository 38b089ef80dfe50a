"""Quality rules: fixed base rules, then a decision list learned by sequential covering.

Statistics, base rules and the learned list are Spark column expressions. Only the statistics of a
bounded sample of labelled documents reach the driver, where the list is grown and pruned.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows are judged
alike; an empty table gives no rows; without labels of both classes nothing is learned and only the
base rules reject; columns other than the id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from . import text_stats
from .common import label_sample, let

FIT_ROWS = 6000  # labelled documents the list is learned from, at most
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9  # of a learned rule on the sample; half on the part it wasn't grown on


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # true: value >= threshold, else value < threshold
    threshold: float

    def holds(self, c: dict) -> Column:
        return (c[self.feature] >= self.threshold) if self.above else (c[self.feature] < self.threshold)


@dataclass(frozen=True)
class DecisionList:
    """Conjunctions tried in order: a text that meets one is rejected, the rest are kept."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def first_rule(self, values: dict) -> Column:
        """Number of the first rule met, from 1; 0 if none."""
        number = F.lit(0)
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            met = F.lit(True)
            for condition in rule:
                met = met & condition.holds(values)
            number = F.when(met, F.lit(k)).otherwise(number)
        return number

    def describe(self) -> list[str]:
        text = [" and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.threshold:.6g}" for c in r) for r in self.rules]
        return [f"reject if {t}" for t in text] + ["otherwise keep"]


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def judged(text: Column, rules: DecisionList) -> Column:
    """Struct: all counts, base_failed, rule (first learned rule met, 0 if none) and kept."""

    def verdict(c: Column) -> Column:
        values = text_stats.ratios(c)
        return let(
            F.struct(base_failed(c).alias("base_failed"), rules.first_rule(values).alias("rule")),
            lambda v: F.struct(
                *[c[name].alias(name) for name in text_stats.COUNTS],
                v["base_failed"].alias("base_failed"),
                v["rule"].alias("rule"),
                (~v["base_failed"] & (v["rule"] == 0)).alias("kept"),
            ),
        )

    return let(text_stats.counts(text), verdict)


def _covered(x: np.ndarray, rule: list[tuple[int, bool, float]]) -> np.ndarray:
    met = np.ones(len(x), bool)
    for f, above, t in rule:
        met &= (x[:, f] >= t) if above else (x[:, f] < t)
    return met


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple[int, bool, float]]:
    """Adds the condition with the largest information gain until only bad texts are covered."""
    rule: list[tuple[int, bool, float]] = []
    live = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and not bad[live].all():
        p0, n0 = bad[live].sum(), (~bad[live]).sum()
        if not p0:
            break
        before, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for f in range(x.shape[1]):
            order = np.argsort(x[live, f], kind="stable")
            v, y = x[live, f][order], bad[live][order]
            cut = np.flatnonzero(np.diff(v) > 0) + 1  # first place above each threshold
            if not len(cut):
                continue
            below_p = np.concatenate([[0], np.cumsum(y)])[cut]
            for above, p, n in ((True, p0 - below_p, (len(v) - cut) - (p0 - below_p)), (False, below_p, cut - below_p)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (f, above, float((v[cut[k] - 1] + v[cut[k]]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        live = _covered(x, rule)
    return rule


def _prune(rule: list, x: np.ndarray, bad: np.ndarray) -> list:
    """The prefix of the rule that is worth most on texts it wasn't grown on."""

    def worth(r: list) -> float:
        met = _covered(x, r)
        p, n = bad[met].sum(), (~bad[met]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=rule)


def learn(x: np.ndarray, label: np.ndarray, names: tuple[str, ...]) -> DecisionList:
    """Sequential covering: grow a rule for rejected texts, prune it, take out what it covers."""
    bad = label == 0
    if not bad.any() or bad.all():
        return DecisionList()
    check = np.arange(len(x)) % 3 == 2  # rows come in hash order
    left = np.ones(len(x), bool)
    rules = []
    for _ in range(MAX_RULES):
        grow, prune = left & ~check, left & check
        if not bad[grow].any():
            break
        rule = _prune(_grow(x[grow], bad[grow]), x[prune], bad[prune])
        if not rule:
            break
        met = left & _covered(x, rule)
        unseen = bad[met & check]
        if bad[met].mean() >= MIN_PRECISION and unseen.size and unseen.mean() >= 0.5:
            rules.append(tuple(Condition(names[f], above, t) for f, above, t in rule))
        left &= ~met  # of a rule that isn't sure, too: the next one is grown on the rest
    return DecisionList(tuple(rules))


def labelled_statistics(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, label, x) of at most ``rows`` labelled documents, of no others.

    A repeated id counts once, with the least statistics of its rows that the base rules pass.
    """
    chosen = F.broadcast(label_sample(labels, "quality", rows))
    c = docs.select("doc_id", "text").join(chosen, "doc_id")
    c = c.select("doc_id", "label", text_stats.counts(F.col("text")).alias("c"))
    columns = text_stats.ratios(F.col("c"))
    # the base rules judge the others; a filter here would be pushed below the join, with the statistics
    x = F.when(~base_failed(F.col("c")), F.array(*columns.values()))
    got = c.select("doc_id", "label", x.alias("x")).groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
    return got.filter("x is not null")


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DecisionList:
    """Learns the list from the statistics of at most ``rows`` labelled documents."""
    got = labelled_statistics(docs, labels, rows).collect()
    got.sort(key=lambda r: ((r.doc_id * 2654435761) & 0xFFFFFFFF, r.doc_id, r.x))
    if not got:
        return DecisionList()
    return learn(np.array([r.x for r in got], float), np.array([r.label for r in got]), text_stats.RATIOS)


def assess(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """Id, counts and verdict of every document."""
    judged_rows = docs.select("doc_id", judged(F.col("text"), rules).alias("j"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged_rows.select("doc_id", *[f"j.{n}" for n in counts], "j.base_failed", "j.kept", "j.rule")


def keep(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The kept documents with all their columns."""
    return docs.filter(judged(F.col("text"), rules)["kept"])
