import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cornermart.llm import mixing_coder, packing, range_coder, token_files, word_tokens
from cornermart.session import scratch
from tests.llm.conftest import invented

PATH = word_tokens.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_equal_the_library(library):
    r = random.Random(4)
    alphabet = [*"abcXYZ éÉßǅΣσς漢字İıK \n\t\r\x85\xa0\x1c'sdtl12٣½🙂.,-_|", "<|endoftext|>", "<|startoftext|>", "’", "é", "'ll "]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 50))) for _ in range(1500)] + [invented(3000, 9), "", "x" * 9000]
    encode = word_tokens.WordEncoder(PATH).encode
    for t in texts:
        assert encode(t).tolist() == library(t), t


def test_cache_generations_and_segments_change_nothing(library, monkeypatch):
    monkeypatch.setattr(word_tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(word_tokens, "SEGMENT", 100)
    encode = word_tokens.WordEncoder(PATH).encode
    for seed in range(6):
        text = invented(400, seed)
        assert encode(text).tolist() == library(text)


def plan_of(counts, capacity):
    places = packing.plan(counts, capacity)
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = places.find(length, rank)
    return places, length, sequence, offset


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_all_without_gap(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 64, 1000, 4096])
    counts = Counter(min(capacity, int(r.expovariate(4 / capacity)) + 1) for _ in range(r.choice([1, 50, 4000])))
    counts = dict(sorted(counts.items()))
    places, length, sequence, offset = plan_of(counts, capacity)
    filled = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True):
        filled[s].append((o, n))
    assert len(filled) == places.n_sequences
    for parts in filled.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    bound = math.ceil(int(length.sum()) / capacity)
    assert places.n_sequences <= max(bound + 2, round(1.1 * bound)) or len(length) < 60


def test_exact_complements_are_found():
    assert plan_of({3: 1, 7: 1}, 10)[0].n_sequences == 1
    assert plan_of({2: 1, 3: 1, 5: 1}, 10)[0].n_sequences == 1
    assert plan_of({1: 1, 2: 1, 3: 1, 4: 1}, 10)[0].n_sequences == 1
    assert plan_of({6: 4, 4: 4, 5: 6}, 10)[0].n_sequences == 7
    assert plan_of({9: 2}, 10)[0].n_sequences == 2
    assert packing.plan({}, 10).n_sequences == 0


def test_pieces_equal_brute_force(frame, edge_rows, library):
    rows = [*edge_rows, *[(100 + k, invented(30, k)) for k in range(50)]]
    out = packing.pack(frame(rows)).collect()
    want, got = [], [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]
    for doc_id, text in rows:
        ids = np.array([*library(text), 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            want.append((doc_id, k, at, len(own), zlib.crc32(own.tobytes())))
    assert sorted(got, key=str) == sorted(want, key=str)
    ends = defaultdict(list)
    for r in out:
        ends[r.sequence_id].append((r.offset, r.length))
    for parts in ends.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    assert packing.pack(frame([])).count() == 0


@pytest.mark.parametrize("high", [1, 2, 12, 300, 65536])
def test_coder_round_trips(high):
    rng = np.random.default_rng(high)
    blocks = [rng.integers(0, high, n) for n in (1, 2, 3, 17, 500, 2048)] + [np.full(2048, high - 1)]
    words = range_coder.encode(blocks)
    back = range_coder.decode(words, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))
    alone = range_coder.encode(blocks[3:4])[0]
    assert np.array_equal(alone, words[3])  # a block doesn't depend on its neighbours


def test_coder_predicts_repeats():
    block = np.tile(np.random.default_rng(1).integers(0, 49000, 40), 50)
    size = 32 * len(range_coder.encode([block])[0]) / len(block)
    assert size < 4  # bits per id, of 16


def test_coder_mixes_better_than_zlib_packs(library):
    """Equal blocks of 16-bit ids: every order's share counts, also where no prediction holds."""
    ids = np.array(library(invented(40_000, 3)))
    blocks = [ids[k : k + range_coder.BLOCK] for k in range(0, len(ids), range_coder.BLOCK)]
    words = range_coder.encode(blocks)
    packed = sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks)
    assert 4 * sum(len(w) for w in words) < 0.9 * packed
    draws = np.random.default_rng(5).choice(49_000, 30)[np.random.default_rng(6).integers(0, 30, range_coder.BLOCK)]
    even = 32 * len(range_coder.encode([draws])[0]) / len(draws)
    assert even < math.log2(30) + 1.2  # order 0 alone, learning included


def test_mixed_distribution_is_whole():
    """The digits' intervals lie end to end over the whole, none empty, and decoding finds each."""
    r = np.random.default_rng(7)
    lanes = range_coder._Lanes(np.full(50, 400))
    for _ in range(400):
        x = np.where(r.random(50) < 0.6, 4321, r.integers(0, 1 << 16, 50))
        f = range_coder._Foretold(lanes, 50)
        for level in range(range_coder.LEVELS):
            digit = (x >> (12 - 4 * level)) & 15
            mixed = range_coder._Digit(lanes, level, lanes.node(50, level, x >> (16 - 4 * level)), f)
            end = np.zeros(50, np.int64)
            for d in range(16):
                begin, size = mixed.bounds(np.full(50, d))
                assert (begin == end).all() and (size > 0).all()
                assert (mixed.find(begin) == d).all() and (mixed.find(begin + size - 1) == d).all()
                end = begin + size
            assert (end == 1 << range_coder.TOTAL).all()
            mixed.bounds(digit)
            mixed.learn(digit, f)
        lanes.learn(50, x, f)


@pytest.mark.parametrize("right", [(True, False), (False, True), (True, True), (False, False)])
def test_every_digit_stays_possible(right):
    """However long one order foretells rightly and the other wrongly, no digit's interval is empty."""
    c = range_coder
    lanes, x = c._Lanes(np.array([10_000])), np.array([0x1234])
    for turn in range(600):
        f = c._Foretold(lanes, 1)
        f.id1, f.id2 = (x if ok else x ^ 0xFFFF for ok in right)
        f.k1, f.k2 = np.array([14]), np.array([112])
        for level in range(c.LEVELS):
            digit = (x >> (12 - 4 * level)) & 15
            mixed = c._Digit(lanes, level, lanes.node(1, level, x >> (16 - 4 * level)), f)
            if turn == 0:  # the lopsided weights and the steepest distribution there can be
                heavy, light = (c.MOST, c.LEAST) if right[0] else (c.LEAST, c.MOST)
                lanes.weight[mixed.context] = (heavy << 16) + light
                steep = c.TARGET[int(digit[0])].copy()
                steep[0] = 15
                lanes.split[mixed.node] = steep.view(c.ROW)
                mixed = c._Digit(lanes, level, mixed.node, f)
            assert int((mixed.w1 + mixed.w2)[0]) <= c.MOST + c.LEAST
            assert min(int(mixed.bounds(np.array([d]))[1][0]) for d in range(16)) > 0
            mixed.bounds(digit)
            mixed.learn(digit, f)


def test_rows_of_one_id_spread_over_files(spark, library):
    texts = [invented(20, k) for k in range(400)]
    rows = [(None if k % 2 else 7, t) for k, t in enumerate(texts)]
    path = scratch(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(spark.createDataFrame(rows, "doc_id bigint, text string"), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(path).select("file").distinct().count() > 2
    got = token_files.read(spark, path).collect()
    want = Counter((d, zlib.crc32(np.array([*library(t), 1], "<u4").tobytes())) for d, t in rows)
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None] * 200 + [7] * 200


def test_files_read_back(spark, frame, edge_rows, library, monkeypatch):
    rows = [*edge_rows, *[(100 + k, invented(30, k)) for k in range(50)]]
    path = scratch(spark, "tokens")
    token_files.write(frame(rows), path)
    got = token_files.read(spark, path).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for doc_id, text in ordered:
        ids = np.array([*library(text), 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    empty = scratch(spark, "tokens")
    token_files.write(frame([]), empty)
    assert token_files.read(spark, empty).count() == 0


def test_damage_is_found():
    segment = token_files.Segment([7, None], [np.arange(3000), np.array([1])])
    body = bytearray(segment.body(range_coder.encode(segment.blocks)))
    parsed = token_files.Body(bytes(body))
    ids = parsed.documents(range_coder.decode(parsed.words, parsed.table[:, 0].tolist()))
    assert parsed.doc_ids == [7, None] and ids[0].tolist() == list(range(3000)) and ids[1].tolist() == [1]
    body[-40] ^= 255
    broken = token_files.Body(bytes(body))
    with pytest.raises(ValueError, match="damaged"):
        broken.documents(range_coder.decode(broken.words, broken.table[:, 0].tolist()))
    with pytest.raises(ValueError, match="not a token segment"):
        token_files.Body(b"x" * 100)
    with pytest.raises(ValueError, match="65,536"):
        token_files.Segment([1], [np.array([70000])])


def by_model(blocks):
    model = mixing_coder.Model.restored(mixing_coder.Model.of_blocks(blocks).stored())
    words = mixing_coder.encode(blocks, [model], [0] * len(blocks))
    return model, words, mixing_coder.decode(words, [len(b) for b in blocks], [model], [0] * len(blocks))


@pytest.mark.parametrize("high", [1, 2, 12, 300, 65536])
def test_one_step_coder_round_trips(high):
    rng = np.random.default_rng(high)
    blocks = [rng.integers(0, high, n) for n in (1, 2, 3, 17, 500, 2048)] + [np.full(4096, high - 1)]
    if high == 65536:
        blocks.append(np.arange(high))
    model, words, back = by_model(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))
    assert np.array_equal(mixing_coder.encode(blocks[3:4], [model], [0])[0], words[3])  # beside its model a block needs no other


def test_one_step_intervals_are_whole():
    """The symbols' intervals lie end to end over the whole, none of an id that occurs is empty, and decoding finds each."""
    r = np.random.default_rng(7)
    block = np.where(r.random(4000) < 0.6, 9, r.integers(0, 40, 4000))
    model = mixing_coder.Model.of_blocks([block])
    lanes = mixing_coder._Lanes(np.full(50, 4000), mixing_coder._Order0([model], np.zeros(50, int)))
    for x in block.reshape(-1, 50)[:, :1] + np.arange(50) % 3:
        x = np.minimum(x, len(model.alphabet) - 1)
        step = mixing_coder._Step(lanes, 50)
        end = np.zeros(50, np.int64)
        for d in range(len(model.alphabet)):
            begin, size = step.bounds(np.full(50, d))
            assert (begin == end).all() and (size >= 0).all()
            some = size > 0
            assert (step.find(begin)[some] == d).all() and (step.find(begin + size - 1)[some] == d).all()
            end = begin + size
        assert (end == 1 << mixing_coder.TOTAL).all()
        step.bounds(x)
        step.learn(x)


@pytest.mark.parametrize("order", [1, 2])
def test_order_0_keeps_its_weight(order):
    """However long one order foretells rightly, what it leaves to order 0 has a bound."""
    block = np.arange(3)
    lanes = mixing_coder._Lanes(np.array([4096]), mixing_coder._Order0([mixing_coder.Model.of_blocks([block])], np.zeros(1, int)))
    for t in range(2000):
        step = mixing_coder._Step(lanes, 1)
        step.x1, step.x2 = np.array([1], np.int32), np.array([2], np.int32)
        step.bounds(np.array([order]))
        assert int(step.w0[0]) >= 224, t
        step.learn(np.array([order]))
        lanes.p1[:], lanes.p2[:] = 0, 0


def test_counts_of_a_segment_beat_blocks_alone(library):
    """One step an id packs tighter than four digits of blocks that know nothing of each other, the model included."""
    ids = np.array(library(invented(200_000, 3)))
    blocks = [ids[k : k + range_coder.BLOCK] for k in range(0, len(ids), range_coder.BLOCK)]
    model, words, _ = by_model(blocks)
    alone = 4 * sum(len(w) for w in range_coder.encode(blocks))
    assert 4 * sum(len(w) for w in words) + len(model.stored()) < alone


def test_both_versions_are_read_together():
    def segment(seed):
        return token_files.Segment([seed], [np.random.default_rng(seed).integers(0, 99, 9000)])

    old, new = segment(1), segment(2)
    raw = [old.body(range_coder.encode(old.blocks)), *token_files.encoded([new, old])]
    bodies = [token_files.Body(r) for r in raw]
    assert [b.model is None for b in bodies] == [True, False, False]
    for s, body, blocks in zip((old, new, old), bodies, token_files.blocks_of(bodies), strict=True):
        assert np.array_equal(body.documents(blocks)[0], np.concatenate(s.blocks))


def test_damage_of_words_or_model_is_found():
    ids = np.random.default_rng(3).integers(0, 99, 9000)
    whole = token_files.encoded([token_files.Segment([7], [ids])])[0]
    for at, message in ((len(whole) - 40, "damaged"), (len(whole) // 8, "damaged")):
        broken = bytearray(whole)
        broken[at] ^= 255
        with pytest.raises(ValueError, match=message):
            body = token_files.Body(bytes(broken))
            body.documents(token_files.blocks_of([body])[0])


def test_segments_held_at_once_are_bounded(spark, frame, library, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 50)
    path = scratch(spark, "tokens")
    token_files.write(frame([(k, invented(40, k)) for k in range(60)]), path)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.read(spark, path).collect()}
    for k in range(60):
        ids = np.array([*library(invented(40, k)), 1], "<u4")
        assert got[k] == (len(ids), zlib.crc32(ids.tobytes()))


def test_batches_equal_the_library(library):
    """A batch of texts at once: parts that end in marks, letters of every Latin block, nulls, an array cut from another."""
    r = random.Random(8)
    letters = [chr(c) for c in range(0x20, 0x300)] + list("Σσςẞ漢字🙂")
    odd = ["".join(r.choice(letters) for _ in range(r.randint(1, 3))) + "".join(r.choice("&.'#|>_") for _ in range(r.randint(0, 4))) for _ in range(3000)]
    texts = [" ".join(odd[k : k + 7]) for k in range(0, 3000, 7)] + ["a" + c for c in letters] + [None, "", " ", "<|endoftext|>.", invented(500, 2)]
    got = word_tokens.WordEncoder(PATH).documents(pa.array(["cut off", *texts]).slice(1), 1)
    assert len(got) == len(texts)
    for t, ids in zip(texts, got, strict=True):
        assert ids.tolist() == [*library(t), 1], t


def test_new_words_of_a_batch_are_one_call(monkeypatch):
    """The library is asked once for the ASCII words of a batch, and not again for known ones."""
    encoder, asked = word_tokens.WordEncoder(PATH), []
    spelled = encoder._spelled
    monkeypatch.setattr(encoder, "_spelled", lambda words: asked.append(len(words)) or spelled(words))
    texts = pa.array([invented(400, k) for k in range(20)])
    distinct = {w.rstrip(".").lower() for t in texts.to_pylist() for w in t.split()}
    first = encoder.documents(texts, 1)
    assert asked == [len(distinct)]
    assert all(np.array_equal(a, b) for a, b in zip(first, encoder.documents(texts, 1), strict=True)) and len(asked) == 1


def test_unknown_ends_of_pieces_are_asked_whole(library):
    """Where the ends of pieces can't be told from the ids, each word is asked for by itself."""
    encoder = word_tokens.WordEncoder(PATH)
    encoder.ends_piece[:] = False
    text = invented(200, 4)
    assert encoder.encode(text).tolist() == library(text)


def test_bytes_of_a_segment_stay():
    """Files written before are read, and the same ids give the same bytes."""
    raw = token_files.encoded([token_files.Segment([7], [np.arange(20_000) ** 2 % 997 % 400])])[0]
    assert (len(raw), zlib.crc32(raw)) == (12242, 1352323847)
