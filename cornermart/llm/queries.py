"""One query per corpus operator, with production parameters, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch
from . import bpe, fingerprints, html_extract, language, lm_score, packing, periodic_runs, pii, quality_classifier, quality_rules, ranked_search, simhash, token_files
from .common import table


def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.assess(docs, quality_rules.fit(docs, labels))


def _quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.assess(docs, quality_classifier.fit(docs, labels))


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), pii.trial_key(spark))


def _simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.digest(F.col("print")).alias("fingerprint"), "component_id")


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path)


def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def _ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def _repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by crc32 of the id, ends with repeats of a part of itself."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.detect(table(spark, sf_dir, "documents"), _repeated_tail))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": _html,
    "op2_simhash_dedup": _simhash,
    "op3_quality_classifier": _quality_classifier,
    "op4_best_fit_packing": _packing,
    "op5_bpe": _bpe,
    "op6_language_id": _language,
    "op7_quality_rules": _quality_rules,
    "op8_document_fingerprints": _fingerprints,
    "op9_token_files": _token_files,
    "op10_pii": _pii,
    "op11_ranked_search": _ranked_search,
    "op12_lm_score": _lm_score,
    "op13_periodic_runs": _periodic_runs,
}

_TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLE: dict[str, str] = {
    "op11_ranked_search": f"""
        WITH term AS (SELECT r, doc_id, unnest({_TERMS}) AS t FROM (SELECT row_number() OVER () AS r, * FROM documents)),
        tf AS (SELECT r, any_value(doc_id) AS doc_id, t, count(*) AS tf FROM term GROUP BY r, t),
        size AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
        whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
        weight AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                   FROM tf, whole GROUP BY t, docs),
        asked AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
        scored AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
                          sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
                   FROM asked JOIN weight USING (t) JOIN tf USING (t) JOIN size USING (r), whole GROUP BY item_id, r),
        ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
                   FROM scored WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 20""",
}
