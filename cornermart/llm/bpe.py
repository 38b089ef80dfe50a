"""Byte-level BPE, encoded through a lexicon transducer and decoded back.

1. One pass over all texts counts words (the pieces that merges never cross); the most frequent ones
   and their ids are compiled into a minimal transducer, whose file Spark hands to every executor.
2. In a batch of texts, each distinct word walks the transducer; all words step together in numpy.
   Words it doesn't know are merged exactly by rank, all of a length class together.

Which words are in the lexicon decides how much is merged, never the result.

Defined cases: null and empty texts have no ids and decode to the empty text; the special token's
string in a text is its id; repeated rows encode alike; an empty table gives no rows; columns other
than id and text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from . import transducer
from .common import map_arrow
from .word_tokens import byte_characters, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
LEXICON = 120_000  # words in the transducer, at most
HELD_WORDS = 1_000_000  # distinct words a counting task holds before it hands them on
PLACES = 1 << 52  # that hashes choose from
BATCH_CHARS = 8_000_000  # characters encoded together; longer texts are cut between words
LONGEST = 32  # bytes of words merged in numpy; longer ones use a heap

WHITE = r"\t-\r \x85\xa0  -     　"
#: Runs that hold whole words: a piece never goes on from visible characters into white space.
RUNS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
CUT = re.compile(rf"(?<=[^{WHITE}]) (?=[^{WHITE}])")
#: White space of which a piece may hold a space with what follows it.
SPACED_OUT = re.compile(rf"[{WHITE}]{{3}}|[{WHITE}]{{2}}\Z")
PAIRS = ("  ", " \n", "\n ", "\n\n")  # quick signs that there may be some; so is any white space but these two
RARE = re.compile("[" + "".join(chr(c) for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c)) and chr(c) not in " \n") + "]")
#: How the tokenizer file's pre-tokenizer splits (a fixed value of that format).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Ragged:
    """Rows of different lengths in one array."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, rows: list, dtype) -> Ragged:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return cls(np.fromiter(chain.from_iterable(rows), dtype, int(sizes.sum())), sizes)

    def take(self, rows: np.ndarray) -> Ragged:
        sizes = self.sizes[rows]
        shift = np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes)
        return Ragged(self.flat[shift + np.arange(len(shift))], sizes)

    def grouped(self, counts: np.ndarray) -> Ragged:
        """Neighbouring rows joined, ``counts`` at a time."""
        ends = np.concatenate([[0], np.cumsum(self.sizes)])[np.cumsum(counts)]
        return Ragged(self.flat, np.diff(ends, prepend=0))


class Merges:
    """The merge table of a tokenizer file, looked up for many pairs at once."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        spelled = byte_characters()
        self.of_byte = np.array([vocab[c] for c in spelled], np.int32)
        as_byte = {c: b for b, c in enumerate(spelled)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(max(vocab.values()), *self.specials.values(), 0) + 1
        text: list[bytes] = [b""] * size
        for token, k in vocab.items():
            text[k] = bytes(as_byte[c] for c in token)
        for token, k in self.specials.items():
            text[k] = token.encode()
        self.text = Ragged.of(text, np.uint8)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.none = len(pairs)
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        self.bits = 20
        self.key, self.rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.none, np.int32)
        slot, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):  # linear probing, all pairs at once; the first of a slot stays
            free = self.key[slot[waiting]] < 0
            _, first = np.unique(slot[waiting][free], return_index=True)
            placed = waiting[free][first]
            self.key[slot[placed]], self.rank[slot[placed]] = keys[placed], placed
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slot[waiting] = (slot[waiting] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = (key ^ (key >> 29)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` if it doesn't merge; ids below zero never do."""
        key = (a.astype(np.int64) << 32) | b
        slot = self._slot(key)
        rank, got = self.rank[slot], self.key[slot]
        lost = np.flatnonzero((got != key) & (got >= 0))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & ((1 << self.bits) - 1)
            rank[lost], got[lost] = self.rank[slot[lost]], self.key[slot[lost]]
            lost = lost[(got[lost] != key[lost]) & (got[lost] >= 0)]
        rank[(got != key) | (a < 0) | (b < 0)] = self.none
        return rank

    def merge_equal(self, ids: np.ndarray) -> np.ndarray:
        """Merges rows of ids, filled up with -1 behind, until no pair is left."""
        n, width = ids.shape
        out = ids.copy()
        live, rank = np.arange(n), self.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, -1)
        column = np.arange(width)
        while len(live) and width > 1:
            best = rank.argmin(1)
            lowest = rank[np.arange(len(live)), best]
            open_ = lowest < self.none
            out[live[~open_]] = ids[~open_]
            live, ids, rank, best, lowest = live[open_], ids[open_], rank[open_], best[open_], lowest[open_]
            if not len(live):
                break
            row = np.arange(len(live))
            left = column[None, :] + (column[None, :] > best[:, None])  # closes the gap behind the pair
            ids = np.where(left < width, ids[row[:, None], np.minimum(left, width - 1)], -1)
            ids[row, best] = self.made[lowest]
            gone = column[None, :-1] + (column[None, :-1] > best[:, None])
            rank = np.where(gone < width - 1, rank[row[:, None], np.minimum(gone, width - 2)], self.none)
            before = np.flatnonzero(best > 0)
            at = best[before]
            rank[before, at - 1] = self.find(ids[before, at - 1], ids[before, at])
            behind = np.flatnonzero(best < width - 1)
            at = best[behind]
            rank[behind, at] = self.find(ids[behind, at], ids[behind, at + 1])
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """Merges one long word: a heap of pairs over a linked list."""
        ids = [int(self.of_byte[b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        ranks = self.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), k, ids[k], ids[k + 1]) for k, r in enumerate(ranks) if r < self.none]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[k], ids[j] = int(self.made[r]), -1
            after[k] = after[j]
            if after[k] < len(ids):
                before[after[k]] = k
            for left in ((before[k],) if before[k] >= 0 else ()) + ((k,) if after[k] < len(ids) else ()):
                right = after[left]
                found = int(self.find(np.array([ids[left]]), np.array([ids[right]]))[0])
                if found < self.none:
                    heapq.heappush(heap, (found, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> Ragged:
        """Exact ids of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        order, lengths, flats = [], [], []
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 20), (20, LONGEST)):
            own = np.flatnonzero((sizes > low) & (sizes <= high))
            for some in np.array_split(own, len(own) // 50_000 + 1):
                if not len(some):
                    continue
                column = np.arange(high)[None, :]
                inside = column < sizes[some][:, None]
                bytes_ = data[np.minimum(starts[some][:, None] + column, len(data) - 1)]
                merged = self.merge_equal(np.where(inside, self.of_byte[bytes_], -1))
                used = merged >= 0
                order.append(some), lengths.append(used.sum(1)), flats.append(merged[used])
        for k in np.flatnonzero((sizes > LONGEST) | (sizes == 0)).tolist():
            ids = self.merge_long(words[k]) if words[k] else []
            order.append([k]), lengths.append([len(ids)]), flats.append(np.array(ids, np.int32))
        if not order:
            return Ragged(np.empty(0, np.int32), np.empty(0, np.int64))
        back = np.argsort(np.concatenate(order))
        return Ragged(np.concatenate(flats).astype(np.int32), np.concatenate(lengths).astype(np.int64)).take(back)


def numbered(items: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct items in order of their first places, and each item's number among them."""
    first_place: dict[str, int] = {}
    first = np.fromiter(map(first_place.setdefault, items, range(len(items))), np.int64, len(items))
    number = np.zeros(len(items), np.int64)
    number[np.fromiter(first_place.values(), np.int64, len(first_place))] = np.arange(len(first_place))
    return list(first_place), number[first]


def visible_pieces(shown: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of runs with visible characters, one after the other, and how many each run has."""
    if not shown:
        return [], np.zeros(0, np.int64)
    found = PIECES.findall("\n".join(shown))  # a line break is a word of its own between two runs
    breaks = np.flatnonzero(np.fromiter(map("\n".__eq__, found), bool, len(found)))
    return [p for p in found if p != "\n"], np.diff(breaks, prepend=-1, append=len(found)) - 1


def pieces_of(runs: list[str]) -> list[list[str]]:
    """The words of each run; white-space runs are one word."""
    words, sizes = visible_pieces([r for r in runs if not r.isspace()])
    ends = np.cumsum(sizes).tolist()
    rest = iter(zip([0, *ends], ends))
    return [[r] if r.isspace() else words[slice(*next(rest))] for r in runs]


class Encoder:
    def __init__(self, vocabulary: str, lexicon: transducer.Transducer):
        self.merges, self.lexicon = merges(vocabulary), lexicon
        self.rows = Ragged(np.asarray(lexicon.ids), np.diff(lexicon.row))

    def words(self, words: list[bytes]) -> Ragged:
        """Ids of distinct words: from the transducer, or merged if it doesn't know them."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        rank = self.lexicon.ranks(data, np.cumsum(sizes) - sizes, sizes)
        unknown = np.flatnonzero(rank < 0)
        merged = self.merges.encode_words([words[k] for k in unknown.tolist()])
        both = Ragged(np.concatenate([self.rows.flat, merged.flat]), np.concatenate([self.rows.sizes, merged.sizes]))
        place = rank
        place[unknown] = len(self.rows.sizes) + np.arange(len(unknown))
        return both.take(place)

    def texts(self, texts: list[str]) -> Ragged:
        """Ids of each text."""
        split = re.compile("(" + "|".join(map(re.escape, self.merges.specials)) + ")").split if self.merges.specials else lambda t: [t]
        runs: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        special = self.merges.specials
        for k, text in enumerate(texts):
            size = len(runs)
            for part in split(text):
                runs.append(part) if part in special else runs.extend(RUNS.findall(part))
            counts[k] = len(runs) - size
        distinct, taken = numbered(runs)
        kind = np.fromiter((2 if r in special else r.isspace() for r in distinct), np.int8, len(distinct))
        order = np.argsort(kind, kind="stable")  # visible runs, white space (a run is one word), special tokens
        ordered = [distinct[k] for k in order.tolist()]
        n_shown, n_plain = int((kind == 0).sum()), int((kind < 2).sum())
        words, sizes = visible_pieces(ordered[:n_shown])
        some, flat = numbered(words + ordered[n_shown:n_plain])
        of_word = self.words([w.encode() for w in some])
        of_run = of_word.take(flat).grouped(np.concatenate([sizes, np.ones(n_plain - n_shown, np.int64)]))
        fixed = [special[r] for r in ordered[n_plain:]]
        both = Ragged(
            np.concatenate([of_run.flat, np.array(fixed, np.int32)]),
            np.concatenate([of_run.sizes, np.ones(len(fixed), np.int64)]),
        )
        row = np.empty(len(distinct), np.int64)
        row[order] = np.arange(len(distinct))
        return both.take(row[taken]).grouped(counts)

    def decode(self, ids: np.ndarray) -> str:
        return self.merges.text.take(ids).flat.tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def merges(vocabulary: str) -> Merges:
    return Merges(vocabulary)


@lru_cache(maxsize=2)
def encoder(vocabulary: str, file: str) -> Encoder:
    return Encoder(vocabulary, transducer.load(Path(SparkFiles.get(file))))


def cut_text(text: str) -> list[str]:
    """The text in parts of about BATCH_CHARS, cut where a word begins with its space."""
    parts, at = [], 0
    while len(text) - at > BATCH_CHARS:
        found = CUT.search(text, at + BATCH_CHARS)
        if not found:
            break
        parts.append(text[at : found.start()])
        at = found.start()
    return [*parts, text[at:]]


def in_batches(rows: Iterator[tuple[int | None, str]]) -> Iterator[list[tuple[int | None, str]]]:
    held, size = [], 0
    for row in rows:
        if held and size + len(row[1]) > BATCH_CHARS:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[1])
    if held:
        yield held


def chunks_of(text: str) -> list[str]:
    """The text cut at the space before each word; at other spaces too, where that makes the same words."""
    odd = any(pair in text for pair in PAIRS) or RARE.search(text)
    return CUT.split(text) if odd and SPACED_OUT.search(text) else text.split(" ")


def words_in(chunks: Counter[str], before: str) -> Counter[str]:
    """Words of distinct chunks, each with ``before`` before it, as often as the chunks occur."""
    shown, n_shown, white, n_white = [], [], [], []
    for chunk, n in chunks.items():
        for run in RUNS.findall(before + chunk):
            if run.isspace():
                white.append(run), n_white.append(n)
            else:
                shown.append(run), n_shown.append(n)
    words, sizes = visible_pieces(shown)
    distinct, number = numbered(words + white)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, number, np.concatenate([np.repeat(np.array(n_shown, np.int64), sizes), np.array(n_white, np.int64)]))
    return Counter(dict(zip(distinct, total.tolist(), strict=True)))


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n): every word of every text, and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: Counter[str] = Counter()  # of a text: no space was cut off before it
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            total = words_in(held, " ")
            total.update(words_in(first, ""))
            first.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch["text"]:
                for part in cut_text(text.as_py() or ""):
                    chunks = chunks_of(part)
                    first[chunks[0]] += 1
                    held.update(chunks[1:])
                if len(held) + len(first) > HELD_WORDS:
                    yield hand_on()
        yield hand_on()

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "word string, n bigint").filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, n: int = LEXICON) -> list[bytes]:
    """The words that occur most often in all texts, at most ``n``, and each twice at least.

    A histogram of their counts tells where to cut, so that little more than ``n`` words come to the
    driver; of words about as frequent as the last ones, some are left out by their hash.
    """
    counted = materialise(counted_words(docs).filter((F.col("n") > 1) & (F.octet_length("word") <= LONGEST)), "words")
    step = F.floor(16 * F.log2("n")).cast("int")
    left, cut, share = n, -1, 1.0
    for r in sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("c")).collect(), key=lambda r: -r.step):
        if r.c > left:
            cut, share = r.step, (left + 6 * left**0.5 + 20) / r.c  # a few more than are wanted
            break
        left -= r.c
    place = F.pmod(F.xxhash64("word"), F.lit(PLACES))
    some = counted.filter((step > cut) | ((step == cut) & (place < share * PLACES)))
    return [r["word"].encode() for r in some.orderBy(F.desc("n"), place, "word").limit(n).collect()]


def lexicon_file(docs: DataFrame, vocabulary: str, n: int = LEXICON) -> str:
    """Compiles the lexicon and gives its file to all executors; the file's name there."""
    words = frequent_words(docs, n)
    ids = merges(vocabulary).encode_words(words)
    rows = [x.tolist() for x in np.split(ids.flat, np.cumsum(ids.sizes)[:-1])] if words else []
    path = Path(tempfile.mkdtemp(prefix="lexicon-")) / f"lexicon-{uuid.uuid4().hex}.bin"
    transducer.save(transducer.build(words, rows), path)
    docs.sparkSession.sparkContext.addFile(str(path))
    return path.name


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    vocabulary = vocabulary or vocabulary_path(VOCABULARY)
    file = lexicon_file(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, file)
        for batch in batches:
            rows = zip(batch["doc_id"].to_pylist(), (t.as_py() or "" for t in batch["text"]), strict=True)
            out = []
            for some in in_batches(rows):
                parts = [cut_text(text) for _, text in some]
                counts = np.array([len(p) for p in parts])
                coded = coder.texts([p for x in parts for p in x]).grouped(counts)
                for (doc_id, _), ids in zip(some, np.split(coded.flat, np.cumsum(coded.sizes)[:-1]), strict=True):
                    raw = ids.astype("<u4").tobytes()
                    text = coder.decode(ids).encode()
                    out.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
