"""Token ids in compressed files: written in ascending doc_id order, read back exactly.

Spark sorts the documents into ranges of doc_id; each range becomes one Parquet file whose rows are
self-contained segments of whole documents. A segment's body is

    "CMTF", version (u16), documents (u32), blocks (u32)
    per document: doc_id (i64), whether it is null (u8), ids (u64)
    per block: ids (u32), words (u32), crc32 of its ids as u32 (u32)
    version 3: bytes of the model (u32), the segment's model (see mixing_coder), which has a checksum
    the blocks' range-coded words (u32), all numbers little-endian

Blocks hold at most 4,096 ids and are coded on their own (see mixing_coder), so a damaged one is found
by its checksum and costs no other. Segments of version 2 have no model; range_coder reads their blocks.
Spark's committer makes a rerun of a lost task harmless.

Defined cases: null and empty texts are the end id alone; rows without id come first; rows of one id,
or of none, come in order of a hash of the text, then of the text, and may be in several files; a very
long text is a segment of its own or ends one, in as many blocks as it needs; an empty table gives no rows; ids must be below 65,536; columns other than id and
text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import mixing_coder, range_coder
from .common import map_arrow
from .word_tokens import encoder, vocabulary_path

END_ID = 1
SEGMENT = 1 << 20  # ids after which a segment ends with the document
LANES = 2048  # blocks coded in lock step, about
READ_LANES = 4096  # blocks of version 3 decoded so: they take less memory
MODELS = 12  # segments held at once at most, twice as many when read
MAGIC, VERSION = b"CMTF", 3
HEAD = struct.Struct("<4sHII")
FILE_SCHEMA = "file int, segment int, n_docs int, n_ids bigint, body binary"


class Segment:
    """Documents of one segment: their ids, null where unknown, and token ids."""

    def __init__(self, doc_ids: list[int | None], ids: list[np.ndarray]):
        self.doc_ids, self.sizes = doc_ids, [len(x) for x in ids]
        whole = np.concatenate(ids)
        if whole.size and int(whole.max()) >= range_coder.MAX_ID:
            raise ValueError("ids must be below 65,536")
        self.blocks = [whole[k : k + range_coder.BLOCK] for k in range(0, len(whole), range_coder.BLOCK)]

    def body(self, words: list[np.ndarray], model: bytes | None = None) -> bytes:
        """The segment's bytes: of version 3, or 2 without a model."""
        table = np.array(
            [(len(b), len(w), zlib.crc32(b.astype("<u4").tobytes())) for b, w in zip(self.blocks, words, strict=True)], "<u4"
        )
        return b"".join(
            [
                HEAD.pack(MAGIC, 2 if model is None else VERSION, len(self.doc_ids), len(self.blocks)),
                np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
                np.array([d is None for d in self.doc_ids], "u1").tobytes(),
                np.array(self.sizes, "<u8").tobytes(),
                table.tobytes(),
                b"" if model is None else struct.pack("<I", len(model)) + model,
                *(w.astype("<u4").tobytes() for w in words),
            ]
        )


class Body:
    """A parsed segment: doc ids, sizes, its model if it has one, and the words, lengths and checksums of its blocks."""

    def __init__(self, raw: bytes):
        magic, version, n_docs, n_blocks = HEAD.unpack_from(raw)
        if magic != MAGIC or version not in (2, VERSION):
            raise ValueError("not a token segment of this version")
        at = HEAD.size
        ids, at = np.frombuffer(raw, "<i8", n_docs, at), at + 8 * n_docs
        null, at = np.frombuffer(raw, "u1", n_docs, at), at + n_docs
        self.sizes, at = np.frombuffer(raw, "<u8", n_docs, at).astype(np.int64), at + 8 * n_docs
        self.doc_ids = [None if n else int(d) for d, n in zip(ids, null, strict=True)]
        self.table, at = np.frombuffer(raw, "<u4", 3 * n_blocks, at).reshape(-1, 3), at + 12 * n_blocks
        self.model = None
        if version == VERSION:
            (size,) = struct.unpack_from("<I", raw, at)
            self.model, at = mixing_coder.Model.restored(raw[at + 4 : at + 4 + size]), at + 4 + size
        words = np.frombuffer(raw, "<u4", int(self.table[:, 1].sum()), at)
        self.words = np.split(words, np.cumsum(self.table[:, 1], dtype=np.int64)[:-1]) if n_blocks else []

    def documents(self, blocks: list[np.ndarray]) -> list[np.ndarray]:
        """The ids of each document, from the decoded blocks; their checksums must hold."""
        for k, (block, crc) in enumerate(zip(blocks, self.table[:, 2], strict=True)):
            if zlib.crc32(block.astype("<u4").tobytes()) != int(crc):
                raise ValueError(f"block {k} is damaged")
        return np.split(np.concatenate(blocks), np.cumsum(self.sizes)[:-1])


def _in_lanes(items: list, coder, lanes: int) -> list:
    """``coder`` over the columns of all items, about ``lanes`` at a time, in parts of like size."""
    out, parts = [], max(1, round(len(items) / lanes))
    for k in range(parts):
        part = items[k * len(items) // parts : (k + 1) * len(items) // parts]
        out += coder(*map(list, zip(*part, strict=True))) if part else []
    return out


def encoded(segments: list[Segment]) -> list[bytes]:
    """The bytes of each segment."""
    models = [mixing_coder.Model.of_blocks(s.blocks) for s in segments]
    blocks = [(b, k) for k, s in enumerate(segments) for b in s.blocks]
    words = iter(_in_lanes(blocks, lambda own, of: mixing_coder.encode(own, models, of), LANES))
    return [s.body([next(words) for _ in s.blocks], m.stored()) for s, m in zip(segments, models, strict=True)]


def blocks_of(bodies: list[Body]) -> list[list[np.ndarray]]:
    """The blocks of each segment, of either version."""
    out: list[list[np.ndarray]] = [[]] * len(bodies)
    for version in (2, VERSION):
        some = [k for k, b in enumerate(bodies) if (b.model is None) == (version == 2)]
        models = [bodies[k].model for k in some]
        coded = [(w, int(n), j) for j, k in enumerate(some) for w, n in zip(bodies[k].words, bodies[k].table[:, 0], strict=True)]

        def coder(words: list[np.ndarray], sizes: list[int], of: list[int]) -> list[np.ndarray]:
            return range_coder.decode(words, sizes) if models[0] is None else mixing_coder.decode(words, sizes, models, of)  # noqa: B023

        blocks = iter(_in_lanes(coded, coder, LANES if version == 2 else READ_LANES))
        for k in some:
            out[k] = [next(blocks) for _ in bodies[k].words]
    return out


def write(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encodes whole texts, the end id behind each, into files under ``path``."""
    vocabulary = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, file, number = encoder(vocabulary), TaskContext.get().partitionId(), 0
        held: list[Segment] = []

        def rows(number: int) -> pa.RecordBatch:
            columns = [
                pa.array([file] * len(held), pa.int32()),
                pa.array(range(number, number + len(held)), pa.int32()),
                pa.array([len(s.doc_ids) for s in held], pa.int32()),
                pa.array([sum(s.sizes) for s in held], pa.int64()),
                pa.array(encoded(held), pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["file", "segment", "n_docs", "n_ids", "body"])

        doc_ids, ids, size = [], [], 0
        for batch in batches:
            for doc_id, own in zip(batch["doc_id"].to_pylist(), words.documents(batch["text"], END_ID), strict=True):
                doc_ids.append(doc_id), ids.append(own)
                size += len(own)
                if size >= SEGMENT:
                    held.append(Segment(doc_ids, ids))
                    doc_ids, ids, size = [], [], 0
                    if sum(len(s.blocks) for s in held) >= LANES or len(held) >= MODELS:
                        yield rows(number)
                        number, held = number + len(held), []
        if ids:
            held.append(Segment(doc_ids, ids))
        if held:
            yield rows(number)

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("spread", F.xxhash64("text"))
        .repartitionByRange("doc_id", "spread")
        .sortWithinPartitions("doc_id", "spread", "text")
        .select("doc_id", "text")
    )
    map_arrow(ordered, run, FILE_SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, Body]] = []

        def rows() -> pa.RecordBatch:
            out = []
            for (file, segment, body), blocks in zip(held, blocks_of([b for *_, b in held]), strict=True):
                start = 0
                for doc_id, own in zip(body.doc_ids, body.documents(blocks), strict=True):
                    out.append((file, segment, doc_id, start, len(own), zlib.crc32(own.astype("<u4").tobytes())))
                    start += len(own)
            types = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["file", "segment", "doc_id", "start", "n_tokens", "ids_crc32"])

        for batch in batches:
            for file, segment, body in zip(batch["file"].to_pylist(), batch["segment"].to_pylist(), batch["body"], strict=True):
                held.append((file, segment, Body(body.as_py())))
                if sum(len(b.words) for *_, b in held) >= READ_LANES or len(held) >= 2 * MODELS:
                    yield rows()
                    held = []
        if held:
            yield rows()

    schema = "file int, segment int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    decoded = map_arrow(files.select("file", "segment", "body"), run, schema)
    sizes = files.select("file", "segment", "n_ids")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    inside = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    of_file = sizes.groupBy("file").agg(F.sum("n_ids").alias("n"))
    of_file = of_file.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = sizes.join(of_file, "file").select(
        "file", "segment", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base")
    )
    return decoded.join(bases, ["file", "segment"]).select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )
