import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cornermart.llm import ranked_search
from tests.llm.conftest import invented

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    """All pairs scored."""
    tf = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(1 for x in tf if x), sum(x.total() for x in tf)
    df = Counter(t for x in tf for t in x)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, _), x in zip(docs, tf, strict=True):
            m = 75 + (25 * x.total() * n_docs) // max(total, 1)
            score = 0
            for t in terms(text):
                if x[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * x[t]) // (1000 * x[t] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "item_id bigint, text string, doc_id string, score int")

    return make


def corpus():
    r = random.Random(4)
    docs = [(k, invented(r.randint(0, 200), r.randint(0, 300))) for k in range(400)]
    docs += [(1000 + k, docs[3][1]) for k in range(60)]  # more equal scores than ranks
    asked = [(k, " ".join(r.choice(docs)[1].split()[: r.randint(0, 30)])) for k in range(30)]
    return docs, asked + [(7, asked[7][1]), (None, "an ER été"), (98, None), (99, "nowhere-to-be-found")]


@pytest.mark.parametrize("block_chars", [4_000_000, 1_000])
def test_equals_scoring_all_pairs(frame, items, edge_rows, block_chars):
    docs, asked = corpus()
    docs = docs + list(edge_rows)
    got = ranked_search.search(frame(docs).repartition(5), items(asked), block_chars=block_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, asked)


def test_bounds_leave_out_most_pairs():
    r = np.random.default_rng(1)
    width, n = 300, 4000
    items = np.zeros((64, width))
    for k in range(64):
        items[k, r.choice(width, 5, replace=False)] = r.integers(1, 9000, 5)
    topics = r.integers(0, 60, n)
    row = np.repeat(np.arange(n), 5)
    term = (topics[row] * 5 + np.tile(np.arange(5), n)) % width
    part = r.integers(1, 10**6, len(row)).astype(float)
    search = ranked_search.Search(items, 20)
    search.add(np.arange(n), np.zeros(n, bool), row, term, part)
    dense = np.zeros((n, width))
    dense[row, term] = part
    scores = items @ dense.T
    for item, doc, score in search.found():
        assert scores[item, doc] == score
    best = -np.sort(-scores, axis=1)[:, :20]
    assert (np.sort(search.score[np.argsort(search.order)], axis=1)[:, ::-1] == best).all()
    assert search.scored < 0.2 * scores.size


def test_empty_tables(frame, items):
    assert ranked_search.search(frame([]), items([(1, "a")])).count() == 0
    assert ranked_search.search(frame([(1, "a")]), items([])).count() == 0
    assert ranked_search.search(frame([(1, None), (2, "!")]), items([(1, "a")])).count() == 0


def test_a_very_long_document_is_read_whole(frame, items):
    got = ranked_search.search(frame([(1, "an " * 200_000 + "needle"), (2, "an er")]), items([(5, "needle")])).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [(5, 1, 1)]
