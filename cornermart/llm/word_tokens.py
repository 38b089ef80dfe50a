"""Ids of a public word-level tokenizer file, with a bounded cache of words per worker.

The tokenizer drops white space and never joins across it, so a text's ids are those of its
white-space-separated chunks in turn. Arrow cuts the texts of a batch, numbers their distinct chunks
and parts Latin letters from the marks behind them. Each distinct part is given to the tokenizers
library once and then found in the cache, which is bounded however many words there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, models, pre_tokenizers

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 400_000  # with at most 16 ids each on average
SEGMENT = 1 << 24  # bytes of text handled at once, and characters of a long text
MARKS = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""  # a run of them behind letters is one piece; an apostrophe may begin one with letters
ESCAPED = "".join("\\" + m for m in MARKS)
#: Latin letters in lower case: normalised, and one piece for the library; and letters that become one of them by themselves.
LETTERS = "".join(c for c in map(chr, range(ord("a"), 0x250)) if c.isalpha() and c.lower() == c and c not in "ªµº")
ANY_CASE = "".join(c for c in map(chr, range(0x250)) if c.lower() in set(LETTERS))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for U+0100 onwards in turn.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _gathered(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of the pool that begin at ``first``, end to end."""
    ends = np.cumsum(size)
    at = np.repeat((first - (ends - size)).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return pool.take(at)


class WordEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        model = json.loads(self.tokenizer.to_str())["model"]
        options = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v is not None}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # For pieces that are normalised and spelled in byte characters, each new, so that the library's own cache only costs time.
        self.speller = Tokenizer(models.BPE(model["vocab"], merges, cache_capacity=0, **options))
        self.speller.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ends_piece = np.zeros(max(model["vocab"].values()) + 1, bool)
        if suffix := model["end_of_word_suffix"]:
            self.ends_piece[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        self.table = dict(enumerate(byte_characters())) | {32: " "}
        self.keys, self.ids = pa.array([], pa.string()), np.empty(0, self.dtype)  # known parts, and their ids end to end
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def _spelled(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their numbers for pieces of LETTERS, in one call; None if their ends can't be told."""
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.table)
        ids = np.array(self.speller.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.flatnonzero(self.ends_piece.take(ids)) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) and ends[-1] == len(ids) else None

    def _whole(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers for any chunks."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], self.dtype), np.array([len(ids) for ids in found], np.int64)

    def _places(self, parts: pa.Array) -> np.ndarray:
        """The place of each of these distinct parts among the known ones, to which the others are added."""
        known = pc.index_in(parts, value_set=self.keys)
        place = known.fill_null(-1).to_numpy().astype(np.int64)
        new = place < 0
        if not new.any():
            return place
        if len(self.keys) + int(new.sum()) > CACHE_WORDS or len(self.ids) > 16 * CACHE_WORDS:  # only parts that this batch has are kept
            kept = place[~new]
            self.ids, self.size = _gathered(self.ids, self.first[kept], self.size[kept]), self.size[kept]
            self.keys, place[~new] = self.keys.take(pa.array(kept)), np.arange(len(kept))
        plain = pc.match_substring_regex(parts, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        ascii_ = pc.string_is_ascii(parts).to_numpy(zero_copy_only=False)
        for some, ask in ((new & plain & ascii_, self._spelled), (new & plain & ~ascii_, self._spelled), (new & ~plain, self._whole)):
            if some.any():
                words = parts.filter(pa.array(some))
                ids, size = ask(words) or self._whole(words)
                place[some] = len(self.keys) + np.arange(len(words))
                self.keys = pa.concat_arrays([self.keys, words])
                self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
        self.first = np.cumsum(self.size) - self.size
        return place

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        for space in "\n\t\r":
            texts = pc.replace_substring(texts, space, " ")
        chunks = pc.split_pattern(texts, " ")
        coded = chunks.values.dictionary_encode()
        chunk, which = coded.dictionary, coded.indices.to_numpy()
        plain = pc.match_substring_regex(chunk, f"^[{ANY_CASE}]+[{ESCAPED}]*$")
        low = pc.utf8_lower(chunk)
        stem = pc.if_else(plain, pc.utf8_rtrim(low, MARKS), chunk)
        tail = pc.if_else(plain, pc.utf8_ltrim(low, LETTERS), "")
        parts = pa.concat_arrays([stem, tail]).dictionary_encode()
        place = self._places(parts.dictionary).take(parts.indices.to_numpy()).reshape(2, -1).T.ravel()
        size = self.size.take(place)
        pool, size = _gathered(self.ids, self.first.take(place), size), size.reshape(-1, 2).sum(1)
        first, size = (np.cumsum(size) - size).take(which), size.take(which)
        before = np.concatenate([[0], np.cumsum(size)])
        return _gathered(pool, first, size), np.diff(before.take(chunks.offsets.to_numpy()))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has; null has none."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        parts, sizes, at = [np.empty(0, self.dtype)], [np.empty(0, np.int64)], 0
        while at < len(texts):
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SEGMENT, "right")))
            if ends[to - 1] - done <= SEGMENT:
                ids, size = self._batch(texts.slice(at, to - at).cast(pa.string()))
                parts.append(ids), sizes.append(size)
            else:
                own = [self._batch(pa.array([s], pa.string()))[0] for s in segments(texts[at].as_py())]
                parts += own
                sizes.append(np.array([sum(map(len, own))]))
            at = to
        return np.concatenate(parts), np.concatenate(sizes)

    def documents(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """The ids of each text, the end id behind them."""
        ids, sizes = self.encode_all(texts)
        ends = np.cumsum(sizes)
        ids = np.insert(ids, ends, end)
        ends = (ends + np.arange(1, len(ends) + 1)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


def segments(text: str) -> Iterator[str]:
    """The text with white space as spaces, cut at spaces into parts of SEGMENT characters or more."""
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.find(" ", at + SEGMENT)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    return WordEncoder(path)
