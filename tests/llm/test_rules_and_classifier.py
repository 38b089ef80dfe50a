import math
import re
import zlib

import numpy as np
import pytest
from tests.llm.conftest import invented
from pyspark.sql import functions as F

from cornermart.llm import quality_classifier, quality_rules, text_stats, trees
from cornermart.llm.common import remainder


def counted(text):
    """The statistics by plain loops."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


TEXTS = [
    None, "", " \n\x0b ", "one", "a b c d e f g h a b c d e f g h", "a b c d e f g h x a b c d e f g h", "w " * 40,
    "same line\nsame line\n\n \nother\nsame line", "#*$ %&|<> é 漢 字", "x y\x1cz\x85w", invented(200, 5) + " " + invented(200, 5),
    "p q r s t u v w p q r s t u v w p q r s t u v w",
]


def test_counts_equal_plain_loops(frame):
    got = {
        r.doc_id: r
        for r in quality_rules.assess(frame(list(enumerate(TEXTS))), quality_rules.DecisionList()).collect()
    }
    for k, text in enumerate(TEXTS):
        want = counted(text)
        assert {n: got[k][n] for n in want} == want, text
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert got[k].base_failed == failed and got[k].kept == (not failed)


def junk(k):
    return " ".join(w + "###" for w in invented(60, k).split())


def remainder_of(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


@pytest.fixture(scope="module")
def labelled(spark, frame):
    rows = [(k, invented(80, k) if k % 3 else junk(k)) for k in range(240)]
    labels = spark.createDataFrame(
        [(k, int(k % 3 > 0)) for k in range(240)] + [(1, None), (None, 1), (2, 1)], "doc_id bigint, quality int"
    )
    return frame(rows), labels


def test_decision_list_learns_and_filters(labelled, frame, edge_rows, spark):
    docs, labels = labelled
    rules = quality_rules.fit(docs, labels)
    assert rules.rules and rules.describe()[-1] == "otherwise keep"
    kept = quality_rules.keep(docs, rules)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k in range(240) if k % 3}
    out = quality_rules.assess(frame(edge_rows), rules)
    assert out.count() == len(edge_rows)
    assert quality_rules.assess(frame([]), rules).count() == 0
    none = quality_rules.fit(docs, labels.filter("false"))
    assert none == quality_rules.DecisionList()
    assert quality_rules.fit(docs, labels.withColumn("quality", F.lit(1))) == quality_rules.DecisionList()


def test_rules_and_scores_run_without_python(labelled):
    docs, labels = labelled
    plans = [
        quality_rules.assess(docs, quality_rules.fit(docs, labels)),
        quality_classifier.assess(docs, quality_classifier.fit(docs, labels)),
    ]
    for df in plans:
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_classifier_scores_held_out_documents(labelled, frame, edge_rows):
    docs, labels = labelled
    model = quality_classifier.fit(docs, labels)
    rows = quality_classifier.assess(docs, model).collect()
    assert len(rows) == 240
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.predicted == int(r.doc_id % 3 > 0)
    edge = quality_classifier.assess(frame(edge_rows), model).collect()
    assert len(edge) == len(edge_rows) and all(0 <= r.score <= 1 for r in edge)
    assert quality_classifier.assess(frame([]), model).count() == 0
    nothing = quality_classifier.fit(docs, labels.filter("false"))
    assert {r.score for r in quality_classifier.assess(docs, nothing).collect()} == {1.0}
    one = quality_classifier.fit(docs, labels.filter("quality = 0"))
    assert all(r.score < 0.1 for r in quality_classifier.assess(docs, one).collect())


def test_rule_expression_equals_numpy(labelled):
    docs, labels = labelled
    model = quality_classifier.fit(docs, labels)
    stats = text_stats.ratios(F.col("c"))
    rows = (
        docs.select("doc_id", quality_classifier.score_of(F.col("text"), model).alias("s"), text_stats.counts(F.col("text")).alias("c"))
        .select("s", F.array(*stats.values()).alias("x"))
        .collect()
    )
    for r in rows:
        z = model.intercept
        for weight, path in model.rules:
            z += weight * all((r.x[f] >= t) if above else (r.x[f] < t) for f, above, t in path)
        assert math.isclose(r.s, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_held_out_rows_teach_nothing(labelled):
    docs, labels = labelled
    flipped = labels.withColumn(
        "quality", F.when(remainder(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality_classifier.fit(docs, labels) == quality_classifier.fit(docs, flipped)


def test_a_repeated_id_counts_once_in_the_fit(spark, frame, monkeypatch):
    """However many rows a labelled id has, one row of statistics reaches the driver for it."""
    ids = [k for k in range(40) if remainder_of(k) != 2]
    rows = [(k, invented(80, k)) for k in ids] + [(ids[0], invented(80, 1000 + k)) for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id bigint, quality int")
    for module in (quality_classifier, quality_rules):
        sizes = []
        monkeypatch.setattr(module, "learn", lambda x, y, *names, into=sizes: into.append((len(x), len(y))))
        module.fit(frame(rows), labels)
        assert sizes == [(len(ids), len(ids))]


def test_lasso_drops_noise_and_trees_find_a_threshold():
    rng = np.random.default_rng(3)
    r = (rng.random((600, 12)) < 0.5).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(3 * r[:, 0] - 1.5)))).astype(float)
    _, w = quality_classifier.lasso_logistic(r, y, 0.05)
    assert w[0] > 0.5 and (np.abs(w[1:]) < 0.05).all()
    x = rng.random((500, 3))
    _, forest = trees.boost(x, (x[:, 1] > 0.4).astype(float), 3, 1)
    assert all(t.feature[0] == 1 and abs(t.threshold[0] - 0.4) < 0.05 for t in forest)
    assert quality_classifier.simplified(((0, True, 1.0), (0, True, 2.0), (1, False, 3.0))) == ((0, True, 2.0), (1, False, 3.0))


def test_statistics_are_of_labelled_documents_only(spark, testdata):
    """Nothing computes them below the join with the labels."""
    docs, labels = (spark.read.parquet(f"{testdata}/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    plan = quality_rules.labelled_statistics(docs, labels, 50)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join Inner", 1)
    assert "split(" in above and "split(" not in below
