import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from cornermart.llm import bpe, transducer
from cornermart.llm.word_tokens import vocabulary_path
from tests.llm.conftest import invented

PATH = vocabulary_path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoder(words):
    rows = [bpe.merges(PATH).encode_words([w]).flat.tolist() for w in words]
    return bpe.Encoder(PATH, transducer.build(words, rows))


def test_texts_equal_the_library(library):
    r = random.Random(8)
    alphabet = [*"ab cAé \n\t\r\x85\xa0\x1c'stdl12٣½漢字🙂.,-_ ", "<|endoftext|>", "  ", "\n\n", " '", "'ll", "x" * 40]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 2000, " " * 500, "🙂" * 200, "", invented(2000, 3)]
    for words in ([], [b" the", b"the", b" a", b" an", b"\n", " é".encode()]):
        coder = encoder(words)
        got = coder.texts(texts)
        for text, ids in zip(texts, np.split(got.flat, np.cumsum(got.sizes)[:-1]), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want, text
            assert coder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_transducer_knows_its_words_and_no_others(tmp_path):
    r = random.Random(1)
    words = sorted({bytes(r.choice(b"abcd") for _ in range(r.randint(1, 7))) for _ in range(600)})
    t = transducer.build(words, [[k, k + 1] for k in range(len(words))])
    transducer.save(t, tmp_path / "lexicon")
    t = transducer.load(Path(tmp_path / "lexicon"))
    asked = [*words, *[w + b"x" for w in words[:50]], *[w[:-1] for w in words if w[:-1] and w[:-1] not in words][:50]]
    sizes = np.array([len(w) for w in asked])
    rank = t.ranks(np.frombuffer(b"".join(asked), np.uint8).astype(np.int64), np.cumsum(sizes) - sizes, sizes)
    assert rank.tolist() == [*range(len(words)), *[-1] * (len(asked) - len(words))]
    assert all(t.ids[t.row[k] : t.row[k + 1]].tolist() == [k, k + 1] for k in range(len(words)))


def test_transducer_is_minimal():
    words = [a + b for a in (b"ab", b"cd", b"xy") for b in (b"ing", b"ed", b"s")]
    t = transducer.build(words, [[0]] * 9)
    suffixes = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for word in words for p in [word[:k] for k in range(len(word) + 1)]}
    assert len(t.final) == len(suffixes)


def test_long_words_merge_like_short_ones():
    m = bpe.merges(PATH)
    for word in (b" constitutionally", b"the" * 10, bytes(range(32))):
        assert m.merge_long(word) == m.encode_words([word]).flat.tolist()


def test_round_trip_of_a_table(frame, edge_rows, library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 500)
    rows = [*edge_rows, *[(100 + k, invented(50, k)) for k in range(30)]]
    got = bpe.round_trip(frame(rows)).collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(frame([])).count() == 0


def test_cut_texts_encode_alike(library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 40)
    text = "one two  three\n\nfour five. " * 30
    assert "".join(bpe.cut_text(text)) == text and len(bpe.cut_text(text)) > 5
    got = encoder([]).texts(bpe.cut_text(text)).flat.tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


def test_frequent_words_are_counted_over_all_texts(frame):
    words = bpe.frequent_words(frame([(k, "the cat, the dog") for k in range(200)]), 2)
    assert words[0] in (b" the", b" cat", b" dog", b"the", b",") and len(words) == 2
    assert bpe.frequent_words(frame([(1, None)]), 5) == []


def plain_counts(texts):
    counts = Counter()
    for text in texts:
        counts.update(w for run in bpe.RUNS.findall(text or "") for (words,) in [bpe.pieces_of([run])] for w in words)
    return counts


def test_chunks_make_the_words_of_the_text():
    r = random.Random(6)
    texts = ["".join(r.choice(["a", "b'll", "é1", " ", " ", "\n", "\t", "\u3000", "."]) for _ in range(r.randint(0, 12))) for _ in range(5000)]
    for text in texts:
        first, *rest = bpe.chunks_of(text)
        got = bpe.words_in(Counter([first]), "") + bpe.words_in(Counter(rest), " ")
        assert got == plain_counts([text]), repr(text)


@pytest.mark.parametrize("parts", [1, 40])
def test_the_lexicon_holds_every_word_that_repeats(frame, edge_rows, parts, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_WORDS", 500)
    rows = [*edge_rows, *[(100 + k, invented(r, k).replace(" an ", "\nThe  An\n\n ")) for k, r in enumerate(range(10, 90))]]
    want = {w.encode(): n for w, n in plain_counts(t for _, t in rows).items()}
    found = bpe.frequent_words(frame(rows).repartition(parts))
    assert set(found) == {w for w, n in want.items() if n > 1 and len(w) <= bpe.LONGEST}
    few = bpe.frequent_words(frame(rows).repartition(parts), 50)
    assert len(few) == 50 and min(want[w] for w in few) >= sorted(want.values())[-60] * 2 ** (-1 / 16)
