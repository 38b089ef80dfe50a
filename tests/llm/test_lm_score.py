import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cornermart.llm import lm_score, ngram_trie
from cornermart.llm.elias_fano import EliasFano
from tests.llm.conftest import invented


def tokens(text):
    return (text or "").encode().lower().split() + ["end"]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def rounded(share):
    return 2 ** (-math.ceil(-math.log2(share) * 16 - 1e-9) / 16)


def left_of(shares):
    return 2 ** (-math.ceil(-math.log2(1 - sum(shares)) * 2048 - 1e-9) / 2048)


class PlainModel:
    """The same probabilities from dictionaries."""

    def __init__(self, rows):
        self.c, self.pair, self.triple = Counter(), defaultdict(Counter), defaultdict(Counter)
        for doc_id, text in rows:
            if fold(doc_id) != 1:
                t, u = "start", "start"
                for w in tokens(text):
                    self.c[w] += 1
                    self.pair[u][w] += 1
                    self.triple[t, u][w] += 1
                    t, u = u, w
        self.n, self.v = sum(self.c.values()), len(self.c)

    def own(self, w):
        return (self.c[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    @staticmethod
    def mixed(counts, w, shorter):
        if not counts:
            return shorter
        shares = {x: rounded((c - 0.75) / sum(counts.values())) for x, c in counts.items()}
        return shares.get(w, 0.0) + left_of(shares.values()) * shorter

    def p(self, t, u, w):
        return self.mixed(self.triple.get((t, u)), w, self.mixed(self.pair.get(u), w, self.own(w)))

    def row(self, doc_id, text):
        t, u, total = "start", "start", 0.0
        words = tokens(text)
        for w in words:
            total += math.log10(self.p(t, u, w))
            t, u = u, w
        base = sum(math.log10(self.own(w)) for w in words)
        return (doc_id, fold(doc_id) == 1, len(words), sum(w in self.c for w in words), self.n), (base, total)


def documents():
    r = random.Random(5)
    rows = [(k, invented(r.randint(0, 120), r.randint(0, 60))) for k in range(90)]
    return rows + [(500 + k, "The cat The CAT É é\x1c\x0b" * r.randint(1, 9)) for k in range(12)]


def by_id(df):
    return sorted(((tuple(r)[:5], tuple(r)[5:]) for r in df.collect()), key=str)


@pytest.mark.parametrize(("batch", "shard"), [(12_000_000, 32_000_000), (2_000, 9_000)])
def test_scores_equal_plain_counts(spark, frame, edge_rows, tmp_path, batch, shard):
    rows = documents() + [r for r in edge_rows if len(r[1] or "") < 20_000]
    model = PlainModel(rows)
    expected = sorted((model.row(*r) for r in rows), key=str)
    path = f"{tmp_path}/documents"
    frame(rows).repartition(3).write.parquet(path)
    got = by_id(lm_score.score(spark.read.parquet(path), batch, shard))
    assert [g[0] for g in got] == [e[0] for e in expected]
    for (_, g), (_, e) in zip(got, expected, strict=True):
        assert g == pytest.approx(e, rel=1e-6, abs=1e-6)


def test_probabilities_add_up_to_one():
    model = PlainModel(documents())
    r = random.Random(1)
    contexts = r.sample(sorted(model.triple, key=str), 5) + [("start", "start"), ("no such", "word")]
    for t, u in contexts:
        known = sum(model.p(t, u, w) for w in model.c)
        assert 0.999 < known + model.p(t, u, "no such word either") <= 1 + 1e-9


def test_held_out_texts_are_likelier_than_by_single_words(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")
    rows = [r for r in lm_score.score(docs).collect() if r.held_out]
    assert len(rows) > 100 and sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)
    assert all(r.n_known <= r.n_tokens for r in rows)


def test_long_missing_and_untaught_texts(frame):
    assert lm_score.score(frame([])).count() == 0
    held = next(k for k in range(100) if fold(k) == 1)
    only = lm_score.score(frame([(held, "a b")])).collect()
    assert [tuple(r) for r in only] == [(held, True, 3, 0, 0, 0.0, 0.0)]
    rows = [(0, "a b c d " * 50_000), (1, None), (2, ""), (3, None)]
    found = {r.doc_id: r for r in lm_score.score(frame(rows), 10_000, 100_000).collect()}
    assert found[0].n_tokens == 200_001 and found[1].n_tokens == found[2].n_tokens == 1
    assert found[1].score == found[2].score


def test_equal_batches_are_each_counted(spark, tmp_path):
    path = f"{tmp_path}/documents"
    copies = spark.range(0, 8, 1, 4).selectExpr("0L as doc_id", "'a b c' as text")
    copies.write.parquet(path)
    rows = lm_score.score(spark.read.parquet(path)).collect()
    assert [(r.n_tokens, r.train_tokens) for r in rows] == [(4, 32)] * 8


def test_sequences_equal_plain_search():
    r = np.random.default_rng(1)
    for _ in range(150):
        values = np.sort(r.integers(0, int(2 ** r.uniform(0, 50)) + 1, r.integers(0, 200)))
        level = EliasFano.from_arrays(*EliasFano.of(values).arrays())
        assert (level[np.arange(len(values))] == values).all()
        asked = np.concatenate([values, values + 1, r.integers(0, 2**50, 20), [0, 2**60]])
        assert (level.successor(asked) == np.searchsorted(values, asked)).all()
        assert ((level.find(asked) >= 0) == np.isin(asked, values)).all()


def test_sequences_are_compact():
    values = np.sort(np.random.default_rng(2).choice(1 << 30, 200_000, replace=False))
    size = sum(a.nbytes for a in EliasFano.of(values).arrays())
    assert size * 8 / len(values) < 20  # 11 low bits, six high ones, and counts of these


def test_shares_are_rounded_down_in_order():
    share = np.geomspace(1e-8, 1, 999)
    for fineness in (ngram_trie.FINENESS, ngram_trie.FINER):
        back = ngram_trie.decoded(ngram_trie.coded(share, fineness), fineness)
        assert (back <= share * (1 + 1e-6)).all() and (back >= share * 2 ** (-1 / fineness)).all()
    assert ngram_trie.decoded(ngram_trie.coded(np.zeros(1), 16), 16) == 0


def test_words_are_numbered_as_bytes_are_split():
    texts = ["The cat THE Cat", None, "", " \n\t ", " lead trail ", "É é\x1cx\x0by\x0cz\u2003w\x85\xa0v", "a\x00b A\x00B"]
    for some in (texts, texts[:1], [], [None]):
        words, token, sizes = lm_score._numbered(pa.array(some, pa.string()))
        plain = [(t or "").encode().lower().split() for t in some]
        assert sizes.tolist() == [len(p) + 1 for p in plain] and len(set(words)) == len(words)
        assert [words[k] for k in token] == [w for p in plain for w in [*p, lm_score.END]]


def test_packed_sorts_equal_plain_ones():
    r = np.random.default_rng(4)
    for top in (1, 50, 1 << 30, 1 << 62):  # the largest don't fit beside their number
        for n in (0, 1, 500):
            keys, counts = r.integers(0, top, n), r.integers(0, 9, n)
            distinct, place = ngram_trie.placed(keys)
            want, inverse = np.unique(keys, return_inverse=True)
            assert np.array_equal(distinct, want) and np.array_equal(place, inverse)
            before = keys.copy()
            key, count = ngram_trie.summed([keys[: n // 2], keys[n // 2 :]], [counts[: n // 2], counts[n // 2 :]])
            sums = np.bincount(inverse, counts, len(want)).astype(int)
            assert np.array_equal(key, want[sums > 0]) and np.array_equal(count, sums[sums > 0])
            assert np.array_equal(keys, before)
