import hashlib
import random
import re
import zlib

import pytest

from cornermart.llm import periodic_runs, queries
from tests.llm.conftest import invented


def plain_runs(words):
    """All runs by trying every period."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if i > first and length >= max(12, 2 * q):
                part = words[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            i = max(i, first + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


def odd_words(r):
    """Words with periods inside periods, shifted copies and few letters."""
    k, out = r.choice([1, 2, 2, 3, 5]), []
    for _ in range(r.randint(1, 6)):
        part = [r.randint(1, k) for _ in range(r.randint(1, 12))]
        out += (part * 12)[: r.randint(1, 6 * len(part))]
        out += [r.randint(1, k + 4)] * (r.random() < 0.3)
        out += out[: r.randint(1, 40)] if r.random() < 0.3 else []
    return out


def test_runs_equal_all_periods_tried():
    r = random.Random(7)
    for _ in range(1500):
        words = odd_words(r)
        assert periodic_runs.runs_of(words) == plain_runs(words), words


def test_collapse_keeps_the_first_period():
    words = "x a b c a b c a b c a b c a y".split()
    runs = periodic_runs.runs_of(words)
    assert runs == [(1, 13, 3)]
    assert periodic_runs.collapsed(words, runs) == "x a b c y".split()


@pytest.mark.parametrize(
    ("words", "runs"),
    [
        (["a"] * 200_000, [(0, 200_000, 1)]),
        ("a b c d e f g h".split() * 20_000, [(0, 160_000, 8)]),
        ((["a"] * 300 + ["b"]) * 100, 101),
    ],
)
def test_repetitive_texts_stay_cheap(words, runs):
    found = periodic_runs.runs_of(words)
    assert found == runs if isinstance(runs, list) else len(found) == runs


def test_query_equals_brute_force(spark, frame, edge_rows, tmp_path):
    r = random.Random(3)
    rows = [row for row in edge_rows if len(row[1] or "") < 20_000]
    rows += [(1000 + k, " ".join(f"w{x}" for x in odd_words(r))) for k in range(150)]
    rows += [(2000 + k, invented(r.randint(0, 90), k)) for k in range(150)]
    rows += [(None, invented(40, 1)), (3000, "été\x0bété " * 30), (3001, "a\x1ca a\x85a " * 12)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(plain_row(*row)) for row in rows)


def test_very_long_and_missing_texts(frame):
    found = {r.doc_id: r for r in periodic_runs.detect(frame([(1, "a b c " * 100_000), (2, None), (3, "")])).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 300_000, 3)] and found[1].collapsed == "a b c"
    assert found[2].runs == found[3].runs == [] and found[2].n_words == 0
    assert periodic_runs.report(periodic_runs.detect(frame([]))).count() == 0
