"""Document fingerprints: invertible Bloom lookup sketches of the paragraphs' digests.

A text is cut into paragraphs (lines), these into sentences and runs of eight words at most; each
part's digest, told apart by how often it came before, goes into a sketch of CELLS cells. The sketch
is the fingerprint. Two texts are compared by subtracting their sketches and peeling the digests that
differ; where that fails, for there are too many, it is done again with twice the cells. The likeness
is twice the shared parts over all parts of both (1 for two texts without words).

Defined cases: null and empty texts have the fingerprint of no parts; a table of one document is its
own successor; rows without id come last, repeated ids in descending order of text; an empty table
gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import map_arrow
from .iblt import Sketches, differing
from .neighbours import dealt_in_order

CELLS = 24
RUN = 8  # words of a part, at most
SENTENCE = re.compile(r"(?<=[.!?])[ \t]+|\n")
HELD_DOCS, HELD_CHARS = 256, 4_000_000  # documents compared at once


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of a text's parts; white space within a part doesn't matter."""
    parts = []
    for sentence in SENTENCE.split(text):
        words = sentence.split()
        if len(words) <= RUN:
            if words:
                parts.append(" ".join(words))
        else:
            parts += [" ".join(words[k : k + RUN]) for k in range(0, len(words), RUN)]
    if len(set(parts)) == len(parts):
        return np.array([xxhash.xxh64_intdigest(p) for p in parts], np.uint64)
    seen: Counter[str] = Counter()
    out = []
    for p in parts:
        out.append(xxhash.xxh64_intdigest(p, seed=seen[p]))
        seen[p] += 1
    return np.array(out, np.uint64)


def written(sketches: Sketches) -> list[str]:
    """Each sketch as base64: per cell the count (i32), the keys' xor (u64) and the checks' xor (u32)."""
    cells = np.zeros(sketches.count.shape, [("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
    cells["count"], cells["key"], cells["check"] = sketches.count, sketches.key, sketches.check
    return [base64.b64encode(row.tobytes()).decode() for row in cells]


def edited(text: str, following: str) -> str:
    """The last half of the text, rounded down, replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def likeness(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Likeness of each pair of digest sets, and how many digests differ."""
    both = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], np.int64)
    apart = differing(a, b, cells)
    return np.where(both > 0, (both - apart) / np.maximum(both, 1), 1.0), apart


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_parts", "n_differing"]
SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_parts bigint, n_differing bigint"
)
TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *[pa.int64()] * 2]


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and the likenesses."""

    def rows(held: list[tuple], last: np.ndarray) -> pa.RecordBatch:
        """held: (doc_id, text, its digests, text of the next); last: digests of the last one's next."""
        own = [h[2] for h in held]
        following = [*own[1:], last]
        texts = [edited(h[1], h[3]) for h in held]
        changed = [digests(t) for t in texts]
        near_edited, apart = likeness(own, changed)
        near_next, _ = likeness(own, following)
        columns = [
            [h[0] for h in held],
            [len(h[1]) for h in held],
            [hashlib.sha256(t.encode()).hexdigest() for t in texts],
            written(Sketches.of(own, CELLS)),
            written(Sketches.of(changed, CELLS)),
            near_edited,
            near_next,
            [len(x) for x in own],
            apart,
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        before, size = None, 0  # the row that waits for its successor
        for batch in batches:
            for place, guest, doc_id, text in zip(
                batch["range"].to_pylist(), batch["guest"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], strict=True
            ):
                text = text.as_py()
                if before is not None and before[0] != place:
                    raise RuntimeError(f"document {before[1]} met no successor in range {before[0]}")
                if guest and before is None:
                    continue  # a range's second guest, or a range without rows of its own
                of_this = digests(text)
                if before is not None:
                    held.append((before[1], before[2], before[3], text))
                    size += len(before[2])
                    if guest or len(held) >= HELD_DOCS or size >= HELD_CHARS:
                        yield rows(held, of_this)
                        held, size = [], 0
                before = None if guest else (place, doc_id, text, of_this)
        if before is not None:
            raise RuntimeError(f"document {before[1]} met no successor in range {before[0]}")

    return map_arrow(dealt_in_order(docs), run, SCHEMA)
