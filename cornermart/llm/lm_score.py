"""Language-model scores of documents, from sharded n-gram tries.

1. A task deals its documents into batches. Of each batch it writes the distinct words, pairs and
   triples, with how often they occur in documents to learn from, to the shards that own them: a
   word or pair by its (first) word, a triple by its two words of context. Copies, however many, have
   met in the batch by then.
2. A shard adds up what the batches counted, builds the trie of its n-grams, maps it into memory and
   answers every batch with counts, codes and weights of the n-grams it asked for, in their order.
3. The documents are read and dealt again; each batch meets its answers and adds up the logarithms
   of its documents. A table's rows come in the same order each time; a batch that finds no answers,
   because they didn't, is an error.

Nothing is gathered on the driver and no task sees more than one batch or one shard; shards grow in
number with the text. All n-grams of all documents to learn from are in the tries, however rare.

The probability of a word w after t, u is share(t u w) + left(t u) * (share(u w) + left(u) * own(w)) with
own(w) = (c + 0.5) / (N + 0.5 (V + 1)); see ngram_trie for the shares. It adds up to 1 over all words
known and one unknown.

Defined cases: null and empty texts have only their end; a null id counts as the empty text in the
fold; repeated rows get the same scores and are learnt from each; if there is nothing to learn from,
every token has probability 1; an empty table gives no rows; a text is never cut, the longest one
bounds a batch; of n-grams with equal words there are no ties; columns other than id and text are
not read. Words whose hashes agree in 36 bits count as one within pairs and triples; single words
are counted by 63 bits.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_arrow
from .ngram_trie import FINENESS, FINER, Trie, decoded, distinct, placed, summed

BATCH_BYTES = 10_000_000  # text in a batch, about
SHARD_BYTES = 32_000_000  # text for each shard, about
SHORT = 27  # bits of a hash that pairs and triples do without
START, END = b"\n<", b"\n>"  # no word holds a line break


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _hashed(words: Collection[bytes]) -> np.ndarray:
    return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)).astype(np.int64)


def _numbered(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words from START and END on, the number of each token's, and the tokens of each text.

    Arrow lowers only A-Z, and splits at U+0020 and U+0009 to U+000D only.
    """
    pool = pa.system_memory_pool()  # gives memory back at once; Arrow's own keeps it for the worker's life
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null(""), memory_pool=pool), memory_pool=pool)
    real = pc.binary_length(lists.values, memory_pool=pool).to_numpy() > 0  # white space at either end leaves an empty one
    at = lists.offsets.to_numpy()
    before = np.concatenate([[0], np.cumsum(real, dtype=np.int32)])  # real words before each
    sizes = np.diff(before[at]).astype(np.int64) + 1
    del before
    words = lists.values if real.all() else pc.filter(lists.values, pa.array(real), memory_pool=pool)
    del lists, real, at
    found = pc.dictionary_encode(words, memory_pool=pool)
    del words
    token = np.ones(int(sizes.sum()), np.int32)
    inside = np.ones(len(token), bool)
    inside[np.cumsum(sizes) - 1] = False  # the end
    token[inside] = found.indices.to_numpy() + 2
    return [START, END, *found.dictionary.cast(pa.binary()).to_pylist()], token, sizes


def _grouped(keys: np.ndarray, weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct keys, the place of each key among them, and their weights if there are any."""
    distinct, place = placed(keys)
    return distinct, place, None if weight is None else np.bincount(place, weight, len(distinct)).astype(np.int32)


def _triples(u: np.ndarray, t: np.ndarray, w: np.ndarray, m: int, weight: np.ndarray | None) -> tuple:
    """Distinct contexts u * m + t and the place of each token's, then the same of triples and their weights."""
    contexts, context_of = placed(u * m + t)
    return contexts, context_of, *_grouped(context_of.astype(np.int64) * m + w, weight)


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers from 0 up, in as many bytes as the largest needs, byte by byte apart."""
    out = []
    for a in arrays:
        width = (int(a.max(initial=0)).bit_length() + 7) // 8
        cell = 4 if width <= 4 else 8
        planes = a.astype(f"<u{cell}").view(np.uint8).reshape(-1, cell)[:, :width].T
        out.append(len(a).to_bytes(8, "little") + bytes([width]) + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        n, width = int.from_bytes(raw[at : at + 8], "little"), raw[at + 8]
        at += 9
        cell = 4 if width <= 4 else 8
        whole = np.zeros((n, cell), np.uint8)
        whole[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(whole.view(f"<u{cell}").ravel().astype(np.int64))
        at += n * width
    return out


def _split(pairs: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotients and remainders of numbers that aren't negative; one division a number."""
    high = pairs // m
    return high, pairs - high * m


def _gaps(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=0)


def _gaps_within(groups: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Differences of values that rise within neighbouring equal groups; the first of a group stays."""
    out = _gaps(values)
    first = np.diff(groups, prepend=-1) != 0
    out[first] = values[first]
    return out


def _from_gaps_within(groups: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    total = np.cumsum(gaps)
    first = np.flatnonzero(np.diff(groups, prepend=-1))
    return total - np.repeat((total - gaps)[first], np.diff(first, append=len(groups)))


@dataclass
class Batch:
    """The n-grams of some documents, in the order in which shards are asked for them.

    Counts are only there for asking.
    """

    shards: int
    hashes: np.ndarray  # of each word
    learnt: np.ndarray | None  # occurrences of each word to learn from
    short: np.ndarray  # distinct short hashes, sorted
    token: np.ndarray  # word of each token
    last: np.ndarray  # short word before each token
    pairs: np.ndarray
    pair_of: np.ndarray
    pair_count: np.ndarray | None
    contexts: np.ndarray
    context_of: np.ndarray
    triples: np.ndarray
    triple_of: np.ndarray
    triple_count: np.ndarray | None
    sizes: np.ndarray  # tokens of each document

    @classmethod
    def of(cls, texts: pa.Array, learn: np.ndarray | None, shards: int) -> Batch:
        words, token, sizes = _numbered(texts)
        hashes = _hashed(words)
        short, place = placed(hashes >> SHORT)
        m = len(short)
        w = place[token].astype(np.int64)
        first = np.cumsum(sizes) - sizes
        u = np.roll(w, 1)
        u[first] = place[0]
        t = np.roll(u, 1)
        t[first] = place[0]
        weight = None if learn is None else np.repeat(learn.astype(float), sizes)
        pairs, pair_of, pair_count = _grouped(u * m + w, weight)
        contexts, context_of, triples, triple_of, triple_count = _triples(u, t, w, m, weight)
        learnt = None if learn is None else np.bincount(token, weight, len(words)).astype(np.int64)
        del weight, w, t, words
        return cls(
            shards, hashes, learnt, short, token, u.astype(np.int32), pairs, pair_of, pair_count, contexts,
            context_of, triples, triple_of, triple_count, sizes,
        )

    def __post_init__(self):
        m = len(self.short)
        # what each shard owns: words by hash, pairs by first word, triples by context
        own = self.hashes % self.shards
        own[0] = -1  # the start is no token
        self.words_by = np.lexsort((self.hashes, own))
        self.word_cut = np.searchsorted(own[self.words_by], np.arange(self.shards + 1))
        narrow = np.min_scalar_type(self.shards)  # numpy sorts up to 16 bits by their digits
        pair_shard = (self.short % self.shards).astype(narrow)[self.pairs // m]
        self.pairs_by = np.argsort(pair_shard, kind="stable").astype(np.int32)
        self.pair_cut = np.searchsorted(pair_shard[self.pairs_by], np.arange(self.shards + 1))
        last, before = _split(self.contexts, m)
        mixed = self.short[last] * 0x9E3779B1 + self.short[before]
        context_shard = ((mixed >> 7) % self.shards).astype(narrow)
        self.contexts_by = np.argsort(context_shard, kind="stable").astype(np.int32)
        self.context_cut = np.searchsorted(context_shard[self.contexts_by], np.arange(self.shards + 1))
        triple_shard = context_shard[self.triples // m]
        self.triples_by = np.argsort(triple_shard, kind="stable").astype(np.int32)
        self.triple_cut = np.searchsorted(triple_shard[self.triples_by], np.arange(self.shards + 1))

    def _of_shard(self, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words, pairs, contexts and triples that the shard owns, in order."""
        return tuple(
            by[cut[s] : cut[s + 1]]
            for by, cut in (
                (self.words_by, self.word_cut), (self.pairs_by, self.pair_cut),
                (self.contexts_by, self.context_cut), (self.triples_by, self.triple_cut),
            )
        )

    def question(self, s: int) -> bytes:
        m = len(self.short)
        words, pairs, contexts, triples = self._of_shard(s)
        u, w = _split(self.pairs[pairs], m)
        last, before = _split(self.contexts[contexts], m)
        number, third = _split(self.triples[triples], m)
        used = np.zeros(m, bool)
        for a in (u, w, last, before, third):
            used[a] = True
        named = np.flatnonzero(used)
        at = np.cumsum(used) - 1
        successors = np.bincount(np.searchsorted(contexts, number), minlength=len(contexts))
        head = packed([self.hashes[words], self.learnt[words], _gaps(self.short[named])])
        return len(head).to_bytes(8, "little") + head + packed([
            _gaps(at[u]), _gaps_within(u, at[w]), self.pair_count[pairs],
            _gaps(at[last]), _gaps_within(last, at[before]), successors, at[third], self.triple_count[triples],
        ])

    def scores(self, answers: list[bytes]) -> list[np.ndarray]:
        """Per document: tokens, known tokens, all tokens learnt from, base score, score."""
        count = np.zeros(len(self.hashes), np.int64)
        pair, left = np.zeros(len(self.pairs)), np.ones(len(self.short))
        context, triple = np.ones(len(self.contexts)), np.zeros(len(self.triples))
        learnt = distinct = 0
        for s, blob in enumerate(answers):
            of_words, of_pairs, of_contexts, of_triples = self._of_shard(s)
            total, counts, pair_code, firsts, context_left, triple_code = unpacked(blob)
            learnt, distinct = learnt + int(total[0]), distinct + int(total[1])
            count[of_words] = counts
            pair[of_pairs] = decoded(pair_code, FINENESS)
            u = self.pairs[of_pairs] // len(self.short)
            left[u[_gaps(u + 1) > 0]] = decoded(firsts, FINER)
            context[of_contexts] = decoded(context_left, FINER)
            triple[of_triples] = decoded(triple_code, FINENESS)
        own = (count + 0.5) / (learnt + 0.5 * (distinct + 1))
        p = pair[self.pair_of] + left[self.last] * own[self.token]
        p = triple[self.triple_of] + context[self.context_of] * p
        first = np.cumsum(self.sizes) - self.sizes
        known = np.add.reduceat((count > 0)[self.token].astype(np.int64), first)
        base = np.add.reduceat(np.log10(own)[self.token], first)
        return [self.sizes, known, np.full(len(self.sizes), learnt), base, np.add.reduceat(np.log10(p), first)]


def _words_asked(q: bytes) -> list[np.ndarray]:
    """Hashes of the words owned, their counts, and the short hashes that number the words named."""
    own, count, gaps = unpacked(q[8 : 8 + int.from_bytes(q[:8], "little")])
    return [own, count, np.cumsum(gaps)]


def _ngrams_asked(q: bytes) -> list[np.ndarray]:
    """First and second words of pairs, counts; last words and those before, successors; third words, counts."""
    du, dw, n, dlast, dbefore, successors, third, k = unpacked(q[8 + int.from_bytes(q[:8], "little") :])
    u, last = np.cumsum(du), np.cumsum(dlast)
    return [u, _from_gaps_within(u, dw), n, last, _from_gaps_within(last, dbefore), successors, third, k]


class Shard:
    """Sums and the trie of what one shard owns."""

    def __init__(self, questions: list[bytes]):
        hashes, learnt, words = zip(*map(_words_asked, questions), strict=True)
        self.hashes, self.learnt = summed(hashes, learnt)
        names = distinct(np.concatenate(words))
        m = max(len(names), 1)
        pair_keys, pair_counts, contexts, third, triple_counts = [], [], [], [], []
        for q, own in zip(questions, words, strict=True):
            at = np.searchsorted(names, own)
            u, w, n, last, before, successors, x, k = _ngrams_asked(q)
            learnt = n > 0
            pair_keys.append((at[u] * m + at[w])[learnt]), pair_counts.append(n[learnt].astype(np.int32))
            context, learnt = np.repeat(at[last] * m + at[before], successors), k > 0
            contexts.append(context[learnt]), third.append(at[x][learnt].astype(np.int32)), triple_counts.append(k[learnt].astype(np.int32))
        pairs = summed(pair_keys, pair_counts)
        del pair_keys, pair_counts
        known, number = placed(np.concatenate(contexts))
        del contexts
        key, count = summed([number.astype(np.int64) * m + np.concatenate(third)], [np.concatenate(triple_counts)])
        del number, third, triple_counts
        self.trie = Trie.build(names, pairs, (known[key // m], key % m, count)).mapped()

    def answer(self, q: bytes) -> bytes:
        own, _, short = _words_asked(q)
        place = np.searchsorted(self.hashes, own)
        inside = np.minimum(place, max(len(self.hashes) - 1, 0))
        counts = np.zeros(len(own), np.int64)
        if len(self.hashes):
            counts = np.where(self.hashes[inside] == own, self.learnt[inside], 0)
        trie = self.trie
        at = trie.words.find(short)
        u, w, _, last, before, successors, third, _ = _ngrams_asked(q)
        first = at[u[_gaps(u + 1) > 0]]
        left, triple = trie.triples_of(at[last], at[before], successors, at[third])
        return packed([
            np.array([self.learnt.sum(), len(self.hashes)]), counts, trie.pairs_of(at[u], at[w]), trie.pair_left(first), left, triple,
        ])


ROWS = "batch string, place int, body binary"


def _rows(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    types = (pa.string(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["batch", "place", "body"])


def _stored(batch: pa.RecordBatch) -> memoryview:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return memoryview(sink.getvalue())


def _restored(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_next_batch()


def _content(batch: pa.RecordBatch, shards: int, asking: bool) -> Batch:
    return Batch.of(batch["text"], ~batch["held_out"].to_numpy(zero_copy_only=False) if asking else None, shards)


def _dealt(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows put together to about ``limit`` bytes of text; a longer text is alone with its neighbours."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch["text"]], np.int64)
        start = 0
        for k, n in enumerate(sizes.tolist()):
            if size and size + n > limit:
                held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, start = [], 0, k
            size += n + 1
        held.append(batch.slice(start))
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def score(docs: DataFrame, batch_bytes: int = BATCH_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    The model is learnt from the documents that aren't held out, by crc32 of the id.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = size // shard_bytes + 1

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, memoryview, pa.RecordBatch]]:
        for batch in _dealt(batches, batch_bytes):
            body = _stored(batch)
            # named by content, so that answers can't meet other rows; equal batches share their answers
            yield xxhash.xxh3_128_hexdigest(body), body, batch

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, batch in named(batches):
            content = _content(batch, shards, True)
            for s in range(shards):
                yield _rows([(name, s, content.question(s))])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, body, _ in named(batches):
            yield _rows([(name, shards, zstandard.ZstdCompressor(level=5).compress(body))])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[str, int, bytes]] = []  # a partition is one shard
        for batch in batches:
            asked += zip(*(batch[c].to_pylist() for c in ("batch", "place", "body")), strict=True)
        if asked:
            asked.sort()
            shard = Shard([body for _, _, body in asked])
            for name, place, body in asked:
                yield _rows([(name, place, shard.answer(body))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[int, bytes] = {}
        current = None
        for batch in batches:
            for name, place, body in zip(*(batch[c].to_pylist() for c in ("batch", "place", "body")), strict=True):
                if name != current:
                    answers, current = {}, name
                if place < shards:
                    answers[place] = body
                    continue
                if len(answers) != shards:
                    raise RuntimeError("the documents came in another order when they were read again; write them as a table first")
                own = _restored(body)
                columns = _content(own, shards, False).scores([answers[s] for s in range(shards)])
                names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays([own["doc_id"], own["held_out"], *map(pa.array, columns)], names)

    asked = map_arrow(rows, ask, ROWS).repartitionById(shards, "place")
    met = map_arrow(asked, answer, ROWS).unionByName(map_arrow(rows, keep, ROWS))
    met = met.repartition(2 * shards, "batch").sortWithinPartitions("batch", "place")
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return map_arrow(met, finish, schema)
