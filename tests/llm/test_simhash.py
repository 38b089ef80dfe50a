import re

import numpy as np
import xxhash

import corpus_pipeline
from cornermart.llm import bktree, simhash
from tests.llm.conftest import invented


def plain_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def plain_components(prints, radius):
    """Smallest reachable place of each print, by comparing all."""
    label = list(range(len(prints)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return [root(k) for k in range(len(prints))]


def test_components_equal_brute_force(frame, edge_rows):
    rows = list(edge_rows) + [(100 + k, invented(40, k)) for k in range(40)]
    rows += [(200 + k, invented(400, 7).replace(" an ", f" x{k} ", 1)) for k in range(30)]
    rows += [(300 + k, " ".join(invented(400, 8).split()[: 400 - k])) for k in range(10)]
    got = simhash.components(frame(rows)).collect()
    assert len(got) == len(rows)
    prints = [plain_print(t) for _, t in rows]
    part = plain_components(prints, 3)
    smallest = {}
    for (doc_id, _), p in zip(rows, part, strict=True):
        if doc_id is not None:
            smallest[p] = min(doc_id, smallest.get(p, doc_id))
    want = sorted(((d, prints[k], smallest.get(part[k])) for k, (d, _) in enumerate(rows)), key=str)
    assert sorted(((r.doc_id, r.print & (2**64 - 1), r.component_id) for r in got), key=str) == want
    assert simhash.components(frame([])).count() == 0


def test_digest_is_16_hex_digits(spark):
    df = spark.createDataFrame([(0,), (-1,), (255,)], "n bigint")
    assert [r[0] for r in df.select(simhash.digest(df.n)).collect()] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]


def test_sliced_shards_lose_no_link(spark):
    """A crowd in one shard, cut into many slices, forms the parts that brute force finds."""
    rng = np.random.default_rng(5)
    prints = [0x123456789ABCDEF0 ^ int(sum(1 << int(b) for b in rng.choice(13, rng.integers(0, 7), replace=False))) for _ in range(120)]
    prints = sorted({*prints, *[int(x) for x in rng.integers(0, 2**63, 40)]})
    df = spark.createDataFrame([(p,) for p in prints], "print bigint")
    for radius in (1, 3):
        stars = {r.a: r.b for r in simhash.contract(simhash.links(df, radius, slice_size=7)).collect()}
        want = plain_components(prints, radius)
        for k, p in enumerate(prints):
            for j in range(k):
                assert (stars.get(p, p) == stars.get(prints[j], prints[j])) == (want[k] == want[j])


def test_forest_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    prints = np.concatenate([prints, prints ^ np.uint64(5), prints[:50] ^ np.uint64(1 << 40)])
    shard = rng.integers(0, 4, len(prints))
    forest = bktree.Forest(prints, shard)
    found = {(int(q), int(n)) for qs, ns in forest.near(prints, shard, 3) for q, n in zip(qs, ns, strict=True)}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(near & (shard[:, None] == shard[None, :])), strict=True)}


def test_chains_contract(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(60)] + [(5, 5), (200, 100)], "a bigint, b bigint")
    assert {(r.a, r.b) for r in simhash.contract(edges).collect()} == {(k, 0) for k in range(1, 61)} | {(200, 100)}


def test_keep_one_keeps_columns_and_one_row_of_each_group(frame, edge_rows):
    docs = frame(edge_rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = {(r.doc_id, r.component_id) for r in simhash.components(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted((d for d, c in found if d == c), key=str)
    twice = frame([(1, "b b b b"), (1, "a a a a"), (1, "a a a a")])
    assert [(r.doc_id, r.text) for r in simhash.keep_one(twice).collect()] == [(1, "a a a a")]
    assert simhash.keep_one(frame([])).count() == 0


def test_every_group_keeps_a_row_whatever_its_ids(spark, frame):
    """Groups without ids and groups named by one repeated id; a duplicate never stays for a unique text."""
    a, b, c, d, e = (invented(80, k) for k in range(50, 55))
    docs = frame([(None, a), (None, a), (None, b), (None, c), (3, c), (1, d), (1, e), (1, e), (2, e), (0, a + " "), (4, None)])
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.dedup_stage(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(None, b), (3, c), (1, d), (1, e), (0, a + " "), (4, None)], key=str)
    lone = frame([(None, a), (None, b), (None, b), (0, min(d, e)), (1, min(d, e)), (1, max(d, e))])
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(lone).collect()]
    assert sorted(kept, key=str) == sorted([(None, a), (None, b), (0, min(d, e)), (1, max(d, e))], key=str)
