import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from cornermart.llm import packing, pii, quality_classifier, quality_rules, queries, simhash
from cornermart.llm.common import table
from cornermart.session import materialise


@pytest.fixture(scope="module")
def small(testdata):
    return f"{testdata}/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert [n for n in names if n.startswith("op")] and set(queries.QUERIES) < set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_dedup", "pii", "best_fit_packing"]


def test_stages_follow_their_operators(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    kept = docs
    for (_, stage), number in zip(corpus_pipeline.STAGES, (7, 3, 2, 10, 4), strict=True):
        out = materialise(stage(spark, kept, small))
        ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        if number == 7:
            verdicts = quality_rules.assess(kept, quality_rules.fit(docs, labels)).filter("kept")
            assert ids == {r.doc_id for r in verdicts.collect()}
        elif number == 3:
            scores = quality_classifier.assess(kept, quality_classifier.fit(kept, labels)).filter("predicted = 1")
            assert ids == {r.doc_id for r in scores.collect()}
        elif number == 2:
            assert ids == {r.component_id for r in simhash.components(kept).collect()}
        elif number == 10:
            assert {tuple(r) for r in out.select("doc_id", "text").collect()} == {(r.doc_id, r.text) for r in pii.report(kept).collect()}
        else:
            columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
            assert sorted(out.select(columns).collect()) == sorted(packing.pack(kept).select(columns).collect())
        if number != 4:
            assert out.columns == docs.columns
        kept = out
    whole = corpus_pipeline.run(spark, small)
    assert {r.doc_id for r in whole.collect()} == ids


def test_columns_with_the_stages_own_names_pass(spark, frame, testdata):
    """Null and long texts, repeated rows and columns named like helpers go through every stage."""
    labels = table(spark, f"{testdata}/sf0.001", "labels")
    good = [r.text for r in table(spark, f"{testdata}/sf0.001", "documents").join(labels.filter("quality = 1"), "doc_id").limit(6).collect()]
    rows = [(k, t) for k, t in enumerate(good)] + [(0, good[0]), (50, None), (51, ""), (52, " ".join(good * 40)), (None, good[1] + " and more")]
    docs = frame(rows).withColumns({"_kept": F.lit(1), "_rows": F.lit("a"), "_pseudonymised": F.lit(2), "_ID": F.lit(3), "kept": F.lit(True)})
    for name, stage in corpus_pipeline.STAGES[2:]:
        out = materialise(stage(spark, docs, f"{testdata}/sf0.001"))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            docs = out
    assert out.count() > 0
    assert docs.filter("doc_id = 0").count() == 1


def test_an_empty_table_passes_all_stages(spark, small):
    docs = table(spark, small, "documents").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, small))
        assert docs.count() == 0
