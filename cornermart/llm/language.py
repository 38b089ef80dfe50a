"""Language identification with a byte-level convolutional network.

The network is trained on windows of a bounded sample of labelled documents, about equally many of
each language, and reads every window of every text; a document's score is the mean probability over
its windows, weighted by their bytes.

Defined cases: a text that is null or has no letter is ``und`` with score 0; repeated rows agree; an
empty table gives no rows; if no document has a language, all are ``und`` with score 0; source and
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from . import byte_cnn
from .common import held_out, map_arrow

DOCS_PER_LANGUAGE = 500  # labelled documents of each language the network is trained on, about
WINDOWS_PER_DOC = 4
PLACES = 1 << 52  # that hashes choose from
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
HELD = 2048  # windows answered together


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    network: byte_cnn.Network | None


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's UTF-8 bytes in rows of WINDOW, zeros behind the end, and the bytes in each row."""
    raw = np.frombuffer(text.encode(), np.uint8)
    rows = -(-len(raw) // byte_cnn.WINDOW)
    padded = np.zeros(rows * byte_cnn.WINDOW, np.uint8)
    padded[: len(raw)] = raw
    sizes = np.full(rows, byte_cnn.WINDOW)
    if rows:
        sizes[-1] = len(raw) - (rows - 1) * byte_cnn.WINDOW
    return padded.reshape(rows, byte_cnn.WINDOW), sizes


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Trains on about ``per_language`` documents of each language, WINDOWS_PER_DOC from each.

    Documents are chosen by a hash of their id and text, outside the held-out fold, and repeated
    rows count once; the windows lie at equal distances over the text.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")
    )
    known = known.withColumn("key", F.xxhash64("doc_id", "text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}
    if not counts:
        return Model((), None)
    place = F.pmod("key", F.lit(PLACES))
    chance = F.lit(0.0)
    for lang, n in counts.items():
        chance = F.when(F.col("lang") == lang, F.lit(min(1.0, 1.1 * per_language / n))).otherwise(chance)
    size = F.length("text")
    parts = [
        F.substring("text", F.floor((size * k) / WINDOWS_PER_DOC).cast("int") + 1, F.lit(byte_cnn.WINDOW))
        for k in range(WINDOWS_PER_DOC)
    ]
    chosen = known.filter(place < chance * PLACES).select("lang", "key", F.array(*parts).alias("parts"))
    got = chosen.groupBy("lang", "key").agg(F.min("parts").alias("parts")).collect()
    got.sort(key=lambda r: (r["key"] % PLACES, r["key"], r["lang"]))
    languages = tuple(sorted({r["lang"] for r in got}))
    number = {lang: k for k, lang in enumerate(languages)}
    windows, label = [], []
    for r in got:
        for part in dict.fromkeys(r["parts"]):
            rows, _ = windows_of(part)
            if len(rows) and LETTER.search(part):
                windows.append(rows[0]), label.append(number[r["lang"]])
    if not windows:
        return Model((), None)
    return Model(languages, byte_cnn.train(np.array(windows), np.array(label), len(languages)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.network.tables() if model.network else None

        def answer(texts: list[str | None]) -> tuple[list[str], list[float]]:
            cut = [windows_of(t) if t and LETTER.search(t) and tables else None for t in texts]
            some = [c for c in cut if c]
            if not some:
                return [UNKNOWN] * len(texts), [0.0] * len(texts)
            p = model.network.probabilities(np.concatenate([w for w, _ in some]), tables)
            sizes = np.concatenate([n for _, n in some])
            first = np.cumsum([0] + [len(n) for _, n in some[:-1]])
            mean = np.add.reduceat(p * sizes[:, None], first) / np.add.reduceat(sizes, first)[:, None]
            best = iter(zip(mean.argmax(1), mean.max(1), strict=True))
            found = [next(best) if c else None for c in cut]
            return [model.languages[f[0]] if f else UNKNOWN for f in found], [min(1.0, float(f[1])) if f else 0.0 for f in found]

        for batch in batches:
            names, scores, held, size = [], [], [], 0
            for text in batch["text"]:
                held.append(text.as_py())
                size += len(held[-1] or "") // byte_cnn.WINDOW + 1
                if size >= HELD:
                    a, b = answer(held)
                    names += a
                    scores += b
                    held, size = [], 0
            if held:
                a, b = answer(held)
                names += a
                scores += b
            columns = [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return map_arrow(rows, run, "doc_id bigint, held_out boolean, lang_pred string, score double")
